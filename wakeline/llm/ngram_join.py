"""N-gram Jaccard join: exact links between documents whose shingle sets are alike.

The universe of shingles is cut by hash into segments, their number set by size band. Two sets that link
differ in at most H shingles, so of H+1 segments (one per shingle of difference, and one more) some segment
holds the same subset in both: its hash is a signature they share. A segment of level two also gives the
hashes of its subset less one shingle (its one-deletion neighbourhood), so it bears one difference itself:
it counts as two segments, and segments can be longer. Levels are allocated by band from the
number of sets in it: rows written against chance meetings expected. Segments that say nothing (poor: empty, or of one
shingle on level two; hot: shared by very many sets) are passed over; spare segments make up for them, their
number allocated by the same costs, and a set that has more such segments keeps them all. So no link is lost.

Signatures only tell which sets may link: sets that share as many as a link would leave form clusters, and
every two sets of a cluster are compared exactly, block against block, inside tasks that hold two bounded blocks.
Copies are one set from the start. Components come from star contraction.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import settle, split_by_ids
from wakeline.llm.shingles import mix, shingles
from wakeline.operators.graph import connected_components
from wakeline.session import cut_lineage

#: Sizes of one band: from a size to this many times it.
BAND_RATIO = 1.25
#: Extra levels for hot segments, as a share of those needed.
HOT_SHARE = 0.05
#: What a pair that meets by chance costs, in rows.
PAIR_COST = 10.0
#: A signature shared by more sets than this is passed over where spare segments allow it.
HOT_SETS = 64
#: A block: at most about so many sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 4096, 1_000_000
#: Sets whose signatures a task remembers having written (copies in one task are written once).
TASK_MEMO = 1 << 20


@dataclass(frozen=True)
class Band:
    """Sizes low..high; level two for the first ``deep`` of ``segments`` segments; levels of poor and of hot segments
    that a set may pass over, by which the levels exceed what is needed."""

    low: int
    high: int
    segments: int
    deep: int
    poor: int
    hot: int


def differences(a: int, b: int, part: tuple[int, int]) -> int:
    """Most shingles in which linked sets of sizes a and b can differ, for a similarity of part[0]/part[1]."""
    p, q = part
    return (a + b) * (q - p) // (q + p)


def bands(counts: dict[int, int], part: tuple[int, int], pair_cost: float = PAIR_COST) -> list[Band]:
    """Bands up to the largest size in ``counts`` (size: number of sets), levels by least expected cost."""
    p, q = part
    out, low, most = [], 1, max(counts, default=0)
    while low <= most:
        high = max(low, int(low * max(BAND_RATIO, q / p)))
        need = differences(high, high * q // p, part) + 1
        sets = sum(n for size, n in counts.items() if low <= size <= high)
        hot = 0 if need == 1 else 1 + int(HOT_SHARE * need)

        def cost(poor: int, deep: int) -> float:
            """Rows written, and pairs met by chance: in poor segments of sets that have more of them than they may pass over."""
            segments = need + poor + hot - deep
            length = low / segments
            empty = math.exp(-length)
            expected = (segments - deep) * empty + 2 * deep * empty * (1 + length)
            over = max(0.0, 1 - sum(math.exp(-expected + j * math.log(expected) - math.lgamma(j + 1)) for j in range(poor + 1)))
            meet = over * over * empty * empty * (segments + 2 * deep * length)
            return sets * (segments + deep * length) + pair_cost * sets * sets / 2 * meet

        poor, deep = 0, 0
        if need > 1:
            choices = [(f, d) for f in sorted({int(need * x) + y for x in (0, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5) for y in (1, 3)})
                       for d in sorted({(need + f + hot) * x // 16 for x in range(9)})]
            poor, deep = min(choices, key=lambda c: cost(*c)) if sets else choices[0]
        out.append(Band(low, high, need + poor + hot - deep, deep, poor, hot))
        low = high + 1
    return out


def _levels(band: Band, need: int) -> int:
    """How many segments, taken in order, have levels that add up to ``need`` and what may be passed over."""
    want = need + band.poor + band.hot
    return min(band.segments, (want + 1) // 2 if want <= 2 * band.deep else want - band.deep)


def signatures(items: np.ndarray, plan: list[Band], part: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, places, levels to share) of a set in the scheme of its own band and, near the lower edge, in the one below.

    place: 2 * segment + (1 if it is the band below), times 2, plus 1 for a segment of level two.
    Levels to share: sets that link have so many in segments that agree and are not poor in this set.
    """
    p, q = part
    size = len(items)
    own = int(np.searchsorted([b.high for b in plan], size))
    out, places, shares = [], [], []
    for k in (own, own - 1):
        if k < 0:
            continue
        band = plan[k]
        if k == own:
            need = differences(size, size * q // p, part) + 1
        elif size * p <= band.high * q:
            need = differences(size, band.high, part) + 1
        else:
            continue
        if need <= 1 and k == own:
            continue  # only the same set can link
        used = _levels(band, need)
        segment = (items % np.uint64(band.segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment, spread = segment[order], mix(items[order], 0x5EED)
        edges = np.searchsorted(segment, np.arange(used + 1))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])
        full = sums[edges[1:]] - sums[edges[:-1]]
        lengths = np.diff(edges)
        salt = mix(np.arange(used, dtype=np.uint64) + np.uint64(k << 32), 0xBA5E)
        ids = np.arange(used)
        deep = ids < band.deep
        weight = 1 + deep
        poor = (lengths == 0) | (deep & (lengths == 1))
        pooring = int(weight[poor].sum())
        keep_all = pooring > band.poor
        mask = np.ones(used, bool) if keep_all else lengths > 0
        place = (2 * ids + (k != own)) * 2 + deep
        out.append(mix(full + salt, 0xF011)[mask])
        places.append(place[mask])
        inside = edges[min(band.deep, used)]
        if inside:
            at = segment[:inside]
            less = mix(full[at] - spread[:inside] + salt[at], 0xF011)
            mask = np.ones(inside, bool) if keep_all else lengths[at] > 1
            out.append(less[mask])
            places.append(place[at][mask])
        shares.append(np.full(sum(map(len, out)) - sum(map(len, shares)), band.poor + band.hot + 1 - pooring))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(places), np.concatenate(shares)


def _keys(items: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        return int(mix(items, 0xA).sum().astype(np.int64)), int(mix(items, 0xB).sum().astype(np.int64))


def set_facts(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, n, key_a, key_b): size and 128-bit identity of every shingle set."""

    @F.arrow_udf("struct<n: bigint, key_a: bigint, key_b: bigint>")
    def facts(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            items = shingles(t, words)
            rows.append((len(items), *_keys(items)))
        n, a, b = (pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ((), (), ())))
        return pa.StructArray.from_arrays([n, a, b], ["n", "key_a", "key_b"])

    return docs.select(F.col(id_col).alias("id"), facts(F.col(text_col)).alias("f")).select("id", "f.*")


def _signature_rows(docs: DataFrame, text_col: str, words: int, plan: list[Band], part: tuple[int, int]) -> DataFrame:
    """(sig, key, place, share) of every set; a task writes a set it has seen only once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sigs, keys, places, shares = [], [], [], []
            for t in batch.column(0).to_pylist():
                items = shingles(t, words)
                if not len(items):
                    continue
                key = _keys(items)[0]
                if key in seen:
                    continue
                if len(seen) >= TASK_MEMO:
                    seen.clear()
                seen.add(key)
                sig, place, share = signatures(items, plan, part)
                sigs.append(sig.view(np.int64))
                places.append(place.astype(np.int32))
                shares.append(share.astype(np.int32))
                keys.append(np.full(len(sig), key))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (sigs, keys, places, shares)], ["sig", "key", "place", "share"])

    return docs.select(text_col).mapInArrow(emit, "sig bigint, key bigint, place int, share int")


def _candidate_edges(rows: DataFrame, spare: DataFrame) -> DataFrame:
    """Edges (u, v) between sets that may link.

    Signatures of few sets give pairs, and a pair is kept if its shared levels are as many as a link would
    have left after poor and hot segments. Hot signatures, of sets that cannot do without them, join their
    sets to the least one.
    """
    by_sig = Window.partitionBy("sig")
    met = cut_lineage(rows.select("*", F.min("key").over(by_sig).alias("least"), F.max("key").over(by_sig).alias("most"),
                                  F.count("*").over(by_sig).alias("rows"))
                      .where("least < most").select("sig", "key", "place", "share", (F.col("rows") > HOT_SETS).alias("hot"),
                                                    (F.col("place").bitwiseAND(2) / 2).cast("int").alias("below")))
    # Levels of the hot segments of each set and scheme, against the levels to spare.
    passed = (met.where("hot").select("key", "below", "place").distinct()
              .groupBy("key", "below").agg(F.sum(1 + F.col("place").bitwiseAND(1)).alias("levels")))
    short = passed.join(spare, ["key", "below"]).where("levels > spare").select("key", "below")
    kept = met.where("hot").join(short, ["key", "below"], "left_semi").select("sig", "key")
    stars = kept.select(F.min("key").over(by_sig).alias("u"), F.col("key").alias("v")).where("u <> v")

    few = met.where("NOT hot").select("sig", "key", "below", "share", (1 + F.col("place").bitwiseAND(1)).alias("level")).distinct()
    one = few.select("sig", F.col("key").alias("u"), F.col("below").alias("u_below"), F.col("share").alias("u_share"), "level")
    two = few.select("sig", F.col("key").alias("v"), F.col("below").alias("v_below"), F.col("share").alias("v_share"))
    shared = (one.join(two, "sig").where("u < v AND u_below + v_below < 2").groupBy("u", "v", "u_below", "v_below")
              .agg(F.sum("level").alias("levels"), F.max(F.greatest("u_share", "v_share")).alias("needed")))
    for side in ("u", "v"):
        hot = passed.select(F.col("key").alias(side), F.col("below").alias(side + "_below"), F.col("levels").alias(side + "_hot"))
        shared = shared.join(hot, [side, side + "_below"], "left")
    lost = F.least(F.coalesce("u_hot", F.lit(0)), F.coalesce("v_hot", F.lit(0)))
    pairs = shared.where(F.col("levels") >= F.col("needed") - lost).select("u", "v")
    return stars.unionByName(pairs).distinct()


def _verify(words: int, part: tuple[int, int]):
    """Compares all sets of one block, or each set of one block with each of another."""
    p, q = part
    schema = pa.schema([("id", pa.int64()), ("linked", pa.int64()), ("via", pa.list_(pa.int64()))])

    def compare(group: pa.Table) -> pa.Table:
        ids, copies, blocks = (np.asarray(group.column(c)) for c in ("id", "copies", "block"))
        two = bool((group.column("low")[0].as_py()) != (group.column("high")[0].as_py()))
        sets = [shingles(t.as_py(), words) for t in group.column("text")]
        n = len(sets)
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(n), sizes)
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        order = np.argsort(code, kind="stable")
        holders = owner[order]  # sets by shingle
        starts = np.searchsorted(code[order], np.arange(len(code) + 1))
        ends_of = np.concatenate([[0], np.cumsum(sizes)])
        parent = np.arange(n)

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        linked, via = np.zeros(n, np.int64), [[] for _ in range(n)]
        first = blocks.min()
        for x in range(n):
            if not sizes[x] or two and blocks[x] != first:
                continue
            mine = code[ends_of[x]:ends_of[x + 1]]
            shared = np.bincount(np.concatenate([holders[starts[c]:starts[c + 1]] for c in mine]), minlength=n)
            alike = (q * shared >= p * (sizes[x] + sizes - shared)) & (sizes > 0)
            alike &= (blocks != blocks[x]) if two else np.arange(n) > x
            for y in np.flatnonzero(alike):
                linked[x] += copies[y]
                linked[y] += copies[x]
                a, b = root(x), root(y)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    via[y].append(int(ids[x]))
        return pa.table([pa.array(ids), pa.array(linked), pa.array(via, pa.list_(pa.int64()))], schema=schema)

    return compare


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
               part: tuple[int, int] = (9, 10), pair_cost: float = PAIR_COST) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id, n_links, sorted by nothing.

    Two documents link when the Jaccard similarity of their sets of ``words``-word shingles is at least
    part[0]/part[1], worked out in integers. component_id is the smallest id reachable by links, the
    document itself included; n_links counts the other documents it links with, copies included.

    A NULL, empty or blank text has the empty set: n_shingles 0, linked with nothing, component its own id.
    Rows without an id take part in no link and get a NULL component. Rows that share an id are one
    document: whatever either links with is one component. Other columns of ``docs`` are not read, whatever
    their names. An empty table gives no rows. Texts of any length are read whole.
    """
    settle(docs.sparkSession)
    spark = docs.sparkSession
    facts = cut_lineage(set_facts(docs, id_col, text_col, words))
    known = facts.where("n > 0 AND id IS NOT NULL")
    classes = known.groupBy("key_a", "key_b", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    # One row for each quarter of a band: the sizes themselves do not come to the driver.
    step = math.log(BAND_RATIO) / 4
    counts = {max(1, int(round(r["mean"]))): r["sets"] for r in classes.groupBy(F.floor(F.log("n") / step).alias("b")).agg(
        F.count("*").alias("sets"), F.avg("n").alias("mean")).collect()}
    largest = known.agg(F.max("n")).first()[0] or 0
    if largest:
        counts.setdefault(largest, 0)
    plan = bands(counts, part, pair_cost)

    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _signature_rows(texts, "text", words, plan, part)
    # Levels of hot segments to spare by set and scheme; the bands are a short list, so this is one expression.
    place_of = F.lit(0)
    for k, band in enumerate(plan):
        place_of = F.when(F.col("n") >= band.low, F.lit(k)).otherwise(place_of)
    spares = F.array(*[F.lit(b.hot) for b in plan]) if plan else F.array(F.lit(0))
    spare = (classes.withColumn("band", place_of)
             .select(F.col("key_a").alias("key"), F.posexplode(F.array(
                 spares[F.col("band")], spares[F.greatest(F.col("band") - 1, F.lit(0))])).alias("below", "spare")).distinct())
    edges = cut_lineage(_candidate_edges(rows, spare))
    nodes = edges.select(F.col("u").alias("node")).unionByName(edges.select(F.col("v").alias("node"))).distinct()
    clusters = connected_components(nodes, edges)

    members = classes.join(clusters.select(F.col("node").alias("key_a"), F.col("component").alias("cluster")), "key_a")
    weights = members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).alias("blocks"))
    # Each block meets every block of its cluster once: low and high name the two.
    dealt = cut_lineage(members.join(weights, "cluster").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
             .select("cluster", F.col("rep").alias("id"), "copies", "block", F.least("block", "other").alias("low"),
                     F.greatest("block", "other").alias("high")))
    near, _ = split_by_ids(texts, "id", dealt)
    found = cut_lineage(dealt.join(near, "id").groupBy("cluster", "low", "high").applyInArrow(
        _verify(words, part), "id bigint, linked bigint, via array<bigint>"))
    links = found.select(F.col("id").alias("u"), F.explode("via").alias("v"))
    joined = connected_components(links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).distinct(), links)
    degrees = found.groupBy(F.col("id").alias("rep")).agg(F.sum("linked").alias("linked"))
    whole = (classes.join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left").join(degrees, "rep", "left")
             .select(*[F.col(c).alias("_" + c) for c in ("key_a", "key_b", "n", "copies")],
                     F.coalesce("component", "rep").alias("component"), F.coalesce("linked", F.lit(0)).alias("linked")))
    out = facts.join(whole, (F.col("n") > 0) & (F.col("key_a") == F.col("_key_a")) & (F.col("key_b") == F.col("_key_b"))
                     & (F.col("n") == F.col("_n")), "left")
    there = F.col("id").isNotNull()
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(there, F.coalesce("component", "id")).alias("component_id"),
                      F.when(there & F.col("component").isNotNull(), F.col("linked") + F.col("_copies") - 1).otherwise(0).alias("n_links"))
