"""How far the sources of a language are apart in their words.

Rows with the same text are collapsed first: one row for each different text of a language, with its number of
copies in each source (counted before the shuffle, so a text that fills a third of the table is one row for each
task and source; a text that is alone does not move). Every text is split into terms once; document frequencies and counts are added with the copies as
weights, and tasks send sums, not occurrences.

Distances are sums over sparse counts. A term that neither of two sources has adds the same number whatever the
term, so only terms that occur in either are looked at: terms are dealt to slices and sources to blocks, and a task
adds up the distances of two blocks over one slice. No row is made for a pair of sources and a term.
All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import settle, split_by_ids
from wakeline.session import cut_lineage

#: Bytes of texts in UTF-8: A-Z lower-cased, those of no term (U+0000 to U+007F but letters) as spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))

#: Sums a task holds before it sends them on.
MOST_SUMS = 1 << 19

#: Sources of a block and terms of a slice, about: a task of two blocks has at most 2 x 64 x 2048 counts.
BLOCK_SOURCES, SLICE_TERMS = 64, 2048

SUMS = "lang string, source string, term string, docs bigint, count bigint"


def collapse(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, text, copies) of every different text of a language; ``copies`` lists (source, n). NULL is ''.

    A list has at most one entry for each source of the language. Texts whose hash no other row of the language has
    are alone and stay where they are; the others are grouped by the text itself."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    keyed = rows.withColumn("key", F.xxhash64("lang", "text"))
    again = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    maybe, alone = split_by_ids(keyed, "key", again)
    by_source = maybe.groupBy("lang", "text", "source").agg(F.count(F.lit(1)).alias("n"))
    groups = by_source.groupBy("lang", "text").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    return groups.unionByName(alone.select("lang", "text", F.array(F.struct("source", F.lit(1).cast("bigint").alias("n"))).alias("copies")))


def _add_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by language, source and term of the texts of one task. The term '' (no term of a text) carries the group itself."""
    docs: dict[tuple[str, str], Counter] = {}
    counts: dict[tuple[str, str], Counter] = {}

    def sums() -> Iterator[pa.RecordBatch]:
        for key, terms in docs.items():
            names = list(terms)
            of = counts[key]
            for a in range(0, len(names), 1 << 16):
                part = names[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(key[0], len(part)), pa.repeat(key[1], len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([terms[t] for t in part], pa.int64()), pa.array([of[t] for t in part], pa.int64())],
                    ["lang", "source", "term", "docs", "count"])

    held = 0
    for batch in batches:
        for row in batch.to_pylist():
            words = row["text"].encode().translate(LETTERS).split()
            different = set(words)
            for copy in row["copies"]:
                key = row["lang"], copy["source"]
                if key not in docs:
                    docs[key], counts[key] = Counter(), Counter()
                d, c, n = docs[key], counts[key], copy["n"]
                held -= len(d)
                d[b""] += n
                if n == 1:
                    d.update(different)
                    c.update(words)
                else:
                    for term, times in Counter(words).items():
                        d[term] += n
                        c[term] += n * times
                held += len(d)
            if held >= MOST_SUMS:
                yield from sums()
                docs.clear()
                counts.clear()
                held = 0
    yield from sums()


def term_counts(docs: DataFrame, least_docs: int, **columns: str) -> DataFrame:
    """(lang, source, term, count) of the terms in at least ``least_docs`` documents of their language, where
    count > 0; and one row with the term '' and count 0 for every group of language and source."""
    settle(docs.sparkSession)
    sums = collapse(docs, **columns).mapInArrow(_add_terms, SUMS)
    # Each task sends a term at most once for each source and time its sums were full, so common terms are not hot.
    by_source = sums.repartition(F.col("lang"), F.col("term")).groupBy("lang", "term", "source").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    kept = by_source.withColumn("in_docs", F.sum("docs").over(Window.partitionBy("lang", "term")))
    return kept.where((F.col("in_docs") >= least_docs) | (F.col("term") == "")).select("lang", "source", "term", "count")


def share(count: Column, total: Column, terms: Column, scale: int, prior: int) -> Column:
    """1 + floor(scale * (count + prior) / (total + prior * terms)), exact up to 38 digits."""
    wide = "decimal(38,0)"
    above = (F.lit(scale).cast("decimal(18,0)") * (count + prior).cast("decimal(19,0)")).cast(wide)
    return F.when(terms > 0, F.call_function("div", above, (total + terms * prior).cast(wide)) + 1)


def _distances(rows: pa.Table) -> pa.Table:
    """Over the terms of one slice that either of two blocks has: (a, b, sum of distances, number of such terms).

    Every source of the two blocks has a row with the term '', which brings its share of a term it does not have."""
    source = rows["source"].combine_chunks().dictionary_encode()
    term = rows["term"].combine_chunks()
    real = pa.compute.not_equal(term, "").to_numpy(zero_copy_only=False)
    term = term.filter(pa.array(real)).dictionary_encode()
    side, code, p = rows["side"].to_numpy(), source.indices.to_numpy(), rows["p"].to_numpy()
    n_terms, names, tables = len(term.dictionary), [], []
    for k in (0, 1):
        here = side == k
        of, first = np.unique(code[here & ~real], return_index=True)
        table = np.repeat(p[here & ~real][first][:, None], n_terms, axis=1)
        table[np.searchsorted(of, code[here & real]), term.indices.to_numpy()[here[real]]] = p[here & real]
        names.append(of)
        tables.append(table)
    (a, b), (left, right) = names, tables
    total = np.array([np.abs(right - row).sum(axis=1) for row in left], np.int64).reshape(-1)
    lang = pa.array([rows["lang"][0].as_py()] * len(total), pa.string())
    return pa.table([lang, source.dictionary.take(pa.array(np.repeat(a, len(b)))), source.dictionary.take(pa.array(np.tile(b, len(a)))),
                     pa.array(total), pa.array(np.full(len(total), n_terms, np.int64))], names=["lang", "source", "item", "value", "seen"])


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, scale: int = 1_000_000_000, prior: int = 5, **columns: str) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: for every two sources of a language the sum over its kept terms of the distance of their shares
    (0 where no term is kept), all ranks, largest first. Part ``term``: the ``top`` terms of a source whose share is
    above the language's, by that distance. Ties by item. NULL text, language or source is ''. A group without terms
    has pairs and no terms; equal rows count each; other columns are not looked at; an empty table gives no rows.
    """
    counts = cut_lineage(term_counts(docs, least_docs, **columns))
    terms = counts.where("term <> ''")
    groups = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = counts.groupBy("lang", "term").agg(F.sum("count").alias("count")).groupBy("lang").agg(
        F.sum("count").alias("lang_total"), F.count(F.when(F.col("term") != "", 1)).alias("v"))
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")).join(langs, "lang")
    zero = F.lit(0).cast("bigint")
    by_group = cut_lineage(groups.join(sources, "lang").select(
        "lang", "source", "total", "v", "lang_total", F.ceil(F.col("n_sources") / BLOCK_SOURCES).alias("blocks"),
        F.coalesce(share(zero, F.col("total"), F.col("v"), scale, prior), zero).alias("base")))

    # Pairs of blocks of sources over slices of terms.
    p = share(F.col("count"), F.col("total"), F.col("v"), scale, prior)
    slices = F.ceil(F.col("v") / SLICE_TERMS)
    rows = terms.join(by_group, ["lang", "source"]).select("lang", "source", "term", "count", p.alias("p"), "blocks", "v", "lang_total")
    dealt = rows.select("lang", "source", "term", "p", "blocks", F.pmod(F.xxhash64("term", F.lit(3)), slices).alias("slice"))
    every = by_group.where("v > 0").select("lang", "source", F.lit("").alias("term"), F.col("base").alias("p"), "blocks",
                                           F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1)).alias("slice"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    others = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    sides = [dealt.unionByName(every).select("lang", "source", "term", "p", "slice", F.lit(side).alias("side"),
                                             *((block.alias("a"), others.alias("b")) if side == 0 else (others.alias("a"), block.alias("b"))))
             for side in (0, 1)]
    near = sides[0].unionByName(sides[1]).groupBy("lang", "slice", "a", "b").applyInArrow(
        _distances, "lang string, source string, item string, value bigint, seen bigint").where("source <> item")
    near = near.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    own = by_group.select("lang", "source", "base", "v")
    other = by_group.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
    pairs = own.join(other, "lang").where("source <> item").join(near, ["lang", "source", "item"], "left")
    value = F.coalesce("value", zero) + (F.col("v") - F.coalesce("seen", zero)) * F.abs(F.col("base") - F.col("item_base"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))

    # Terms that a source uses more than its language.
    whole = terms.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    q = share(F.col("lang_count"), F.col("lang_total"), F.col("v"), scale, prior)
    above = rows.join(whole, ["lang", "term"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - q).alias("value")).where("value > 0")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = [pairs.withColumn("rank", F.row_number().over(order)),
              above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)]
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
