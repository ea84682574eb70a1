"""Threshold-scaled fingerprints of documents.

A fingerprint keeps every shingle hash below a fixed share of the hash space. So the kept part of a union is
the union of the kept parts: fingerprints merge, and containment can be told between very unequal documents.
Written as text: the number of shingles, a digest of the whole set, and the kept hashes in order, in base64.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import settle
from wakeline.llm.shingles import mix, shingles

#: Words of a shingle, and the share of hashes kept: one in so many. With one in two, likeness is off by 0.08 on average
#: for texts of 14 words, 0.05 for 30, 0.02 for 120 and 0.004 for 4,000; sets of one shingle keep none half of the time.
WORDS, ONE_IN = 5, 2
#: Text of one part of the id order, in bytes; quantiles of the ids asked for.
PART_BYTES, CUTS = 64 << 20, 1000
#: One row a part is broadcast up to this many parts, so that the texts do not move for it.
BROADCAST_PARTS = 1 << 18


def write(items: np.ndarray, one_in: int = ONE_IN) -> str:
    """The fingerprint of a sorted set of shingle hashes."""
    kept = items[items < np.uint64(2 ** 64 // one_in)]
    digest = int(mix(items, 0xF1).sum()) if len(items) else 0
    return f"{len(items)}:{digest:016x}:{base64.b64encode(kept.astype('<u8').tobytes()).decode()}"


def read(fingerprint: str) -> tuple[str, np.ndarray]:
    """(identity of the whole set, kept hashes in order)."""
    count, digest, kept = fingerprint.split(":")
    return f"{count}:{digest}", np.frombuffer(base64.b64decode(kept), "<u8")


def merge(a: str, b: str, one_in: int = ONE_IN) -> str:
    """The fingerprint of two documents' shingles taken together. Only kept hashes are known of both, so the
    merged fingerprint counts and digests those."""
    return write(np.union1d(read(a)[1], read(b)[1]).astype(np.uint64), one_in)


def likeness(a: str, b: str) -> float:
    """Jaccard similarity estimated from the kept hashes: 1 for equal sets, 0 if nothing kept is shared."""
    (whole_a, kept_a), (whole_b, kept_b) = read(a), read(b)
    if whole_a == whole_b:
        return 1.0
    shared = len(np.intersect1d(kept_a, kept_b, assume_unique=True))
    union = len(kept_a) + len(kept_b) - shared
    # Sets known to differ are not taken for equal because the hashes kept happen to be the same.
    return min(shared / union, 1 - 2.0 ** -20) if union else 0.0


def containment(a: str, b: str) -> float:
    """Share of a's shingles that b has, estimated; 1 for equal sets, 0 if a keeps nothing."""
    (whole_a, kept_a), (whole_b, kept_b) = read(a), read(b)
    if whole_a == whole_b:
        return 1.0
    return len(np.intersect1d(kept_a, kept_b, assume_unique=True)) / len(kept_a) if len(kept_a) else 0.0


def fingerprint(text: Column, words: int = WORDS, one_in: int = ONE_IN) -> Column:
    """Fingerprint of a text. NULL, empty and blank texts have that of the empty set; equal texts have equal ones."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([write(shingles(t, words), one_in) for t in texts.to_pylist()], pa.string())

    return run(text)


def estimate(a: Column, b: Column, how=likeness) -> Column:
    """``likeness`` or ``containment`` of two fingerprint columns; NULL where either is."""

    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else how(x, y) for x, y in zip(left.to_pylist(), right.to_pylist())], pa.float64())

    return run(a, b)


def with_next(docs: DataFrame, id_col: str, text_col: str, parts: int | None = None) -> DataFrame:
    """(id, text, next_text): every row with the text of the next one by descending id, after the last the first.

    Rows are dealt to parts by id, of about PART_BYTES of text: at up to CUTS quantiles of the ids, each of their ranges
    cut into equal steps of the id. The first row of each part goes to the part before it as well, so one shuffle
    of the texts brings neighbours together and no window is wider than a part. Rows that share an id are ordered
    by text. NULL ids come last. A single row is its own next one.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
        parts = max(4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    ranges = min(parts, CUTS)
    steps = -(-parts // ranges)
    cuts = rows.agg(F.percentile_approx("id", [i / ranges for i in range(ranges + 1)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts), reverse=True)  # at most CUTS + 1
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    # Range 0 has the largest ids; NULL ids are in a range of their own at the end.
    range_of = F.when(F.col("id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(bounds, lambda c: c > F.col("id"))) if cuts else F.lit(0))
    # Ids of range k lie below its upper cut and not below its lower one.
    upper, lower = F.get(bounds, F.col("range") - 1).cast("double"), F.get(bounds, F.col("range")).cast("double")
    step = F.when(F.col("id").isNull() | upper.isNull() | lower.isNull(), F.lit(0)).otherwise(
        F.floor((upper - F.col("id").cast("double")) * steps / (upper - lower)).cast("int"))
    dealt = rows.withColumn("range", range_of)
    dealt = dealt.withColumn("part", F.struct("range", (step if cuts and steps > 1 else F.lit(0)).alias("step")))
    # The first row of a part, its largest id, goes to the part before; that of the first part to the last. One row a part.
    heads = dealt.groupBy("part").agg(F.max("id").alias("head"))
    in_order = Window.orderBy("part")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    loans = heads.select(F.col("part").alias("from_part"), "head", F.coalesce(
        F.lag("part").over(in_order), F.last("part").over(everything)).alias("to"))
    if (ranges + 2) * steps <= BROADCAST_PARTS:
        loans = F.broadcast(loans)  # at most one row a part
    lent = (dealt.join(loans, (F.col("part") == F.col("from_part")) & F.col("id").eqNullSafe(F.col("head")))
            .groupBy("to", "id").agg(F.min("text").alias("text"))
            .select("id", "text", F.col("to").alias("part"), F.lit(False).alias("own")))
    order = Window.partitionBy("part").orderBy(F.desc("own"), F.desc_nulls_last("id"), "text")
    return dealt.drop("range").withColumn("own", F.lit(True)).unionByName(lent).withColumn("next_text", F.lead("text").over(order)).where("own")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, one_in: int = ONE_IN) -> DataFrame:
    """Each document's fingerprint, its edited text's, and their likeness; the edited text has the last half of its
    characters replaced by the first as many of the next document's.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edited_in_own). NULL
    texts count as empty: the edited text of an empty one is empty, and near_edited is 1. See with_next for ties,
    NULL ids and single rows. Other columns are not read. An empty table gives no rows.
    """
    settle(docs.sparkSession)
    rows = with_next(docs, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    prints = (rows.withColumn("edited", edited)
              .select("id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                      fingerprint(F.col("text"), words, one_in).alias("fingerprint"),
                      fingerprint(F.col("edited"), words, one_in).alias("edited_fingerprint"),
                      fingerprint(F.col("next_text"), words, one_in).alias("next_fingerprint")))
    return prints.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         estimate(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         estimate(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                         estimate(F.col("edited_fingerprint"), F.col("fingerprint"), containment).alias("edited_in_own"))
