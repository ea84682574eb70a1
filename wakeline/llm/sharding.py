"""Weighted rendezvous sharding of records by a stable key, in native expressions.

Every shard draws a number for a key from a hash of both; the cost -ln(number)/weight is least for a shard
with the probability its weight has, and a record goes to the shard of least cost. A new shard takes a record
only if its own cost is the least, so records move nowhere else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import free_name, settle
from wakeline.session import cut_lineage

#: Parts into which the rows of a shard are numbered, so that no shard is numbered by one task.
SLOT_BUCKETS = 1024

#: Hex digits of a hash that fit a double exactly (52 bits).
DIGITS = 13


def _number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def key_text(key: Column) -> Column:
    """Text that stands for a key; NULL is a key of its own, unlike any value."""
    return F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("n"))


def cost(key: Column, shard: int, weight: float) -> Column:
    """What a shard asks for a key: exponential, at a rate of its weight."""
    share = (_number(F.concat(key_text(key), F.lit(f"/{shard}")), DIGITS) + F.lit(0.5)) / F.lit(float(16 ** DIGITS))
    return -F.log(share) / F.lit(float(weight))


def shard_of(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key: least cost, ties to the smaller shard. Shards of weight 0 get nothing."""
    bids = [F.struct(cost(key, s, w).alias("cost"), F.lit(s).alias("shard")) for s, w in sorted(weights.items()) if w > 0]
    if not bids:
        raise ValueError("no shard has a weight")
    return F.array_min(F.array(*bids))["shard"]


def with_shards(df: DataFrame, key: str, weights: Mapping[int, float], out: str = "shard") -> DataFrame:
    """``df`` with the shard of every row; needs no shuffle. Rows with equal keys share a shard, NULL keys too."""
    return df.withColumn(out, shard_of(F.col(key), weights))


def with_slots(df: DataFrame, shard: str, order: list[str], out: str = "slot") -> DataFrame:
    """``df`` with a number for each row of a shard: 0, 1, 2 ... without gaps.

    Rows are dealt to buckets by a hash of the columns in ``order``, counted by bucket, and numbered inside
    the bucket after the rows of the buckets before it. Equal rows get different numbers. ``df`` is written
    once to the checkpoint folder, so keep it narrow.
    """
    settle(df.sparkSession)
    bucket, before = free_name(df, "slot_bucket"), free_name(df, "slot_before")
    text = F.concat_ws("/", *[key_text(F.col(c)) for c in order])
    rows = cut_lineage(df.withColumn(bucket, F.pmod(_number(text, 8), F.lit(SLOT_BUCKETS))))
    counts = rows.groupBy(shard, bucket).agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy(shard).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(shard).alias("s"), F.col(bucket).alias("b"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(before))
    inside = F.row_number().over(Window.partitionBy(shard, bucket).orderBy(*order))
    numbered = rows.withColumn(out, inside.cast("bigint") - 1)
    return (numbered.join(starts, (F.col(shard) == F.col("s")) & (F.col(bucket) == F.col("b")))
            .withColumn(out, F.col(out) + F.col(before)).drop("s", "b", bucket, before))


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``, over equal shards.

    size: UTF-8 bytes of the text and one (NULL text: 1, its CRC that of no bytes). law is ``key``: the id
    and the number of shards decide. grown_shard is the shard with one more. NULL ids share a shard;
    repeated rows get slots of their own. Other columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    thin = docs.select(F.col(id_col), (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.lit("key").alias("law"), shard_of(F.col(id_col), dict.fromkeys(range(shards), 1.0)).alias("shard"),
                       shard_of(F.col(id_col), dict.fromkeys(range(shards + 1), 1.0)).alias("grown_shard"))
    return with_slots(thin, "shard", [id_col, "text_crc32", "size"])
