"""Many observations to one row per vessel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.functions.records import record_score
from wakeline.functions.text import present
from wakeline.operators.keyed import top_k


def filled(df: DataFrame, name: str) -> Column:
    kind = dict(df.dtypes)[name]
    return present(name).isNotNull() if kind == "string" else F.col(name).isNotNull()


def newest_nonempty(df: DataFrame, key: str, fields: Sequence[str], order: Sequence[str], sources: str | None = None
                    ) -> DataFrame:
    """Per key, every field takes its newest non-empty value; ``order`` breaks ties, later wins.

    One partial aggregation: a busy key is reduced on the map side before it is shuffled.
    """
    position = F.struct(*order)
    aggs = [F.max_by(F.col(f), F.when(filled(df, f), position)).alias(f) for f in fields]
    if sources:
        aggs.append(F.array_sort(F.collect_set(sources)).alias("sources"))
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs, F.count("*").alias("merged_rows"))


def latest_two(df: DataFrame, key: str, at: str, seq: str) -> DataFrame:
    """Latest two distinct times per vessel. Same-time rows: higher score, then first seen.

    The group limit drops rows older than a task's two latest times before the shuffle, so only the
    newest rows of a key move; the choice among same-time rows uses the same partitioning.
    """
    recent = df.withColumn("rank", F.dense_rank().over(Window.partitionBy(key).orderBy(F.col(at).desc()))).where("rank <= 2")
    scored = recent.withColumn("_score", record_score(df.columns))
    return top_k(scored, [key, at], [F.col("_score").desc(), F.col(seq)]).drop("_score")


def duplicate_counters(df: DataFrame, key: str, at: str, lat: str, lon: str) -> DataFrame:
    """Whole-set counters: same-time duplicates, same-time conflicts, older positions discarded."""
    per_time = df.groupBy(key, at).agg(F.count("*").alias("n"), F.count_distinct(lat, lon).alias("places"))
    per_key = per_time.groupBy(key).agg(
        F.sum(F.col("n") - F.col("places")).alias("dup"), F.sum(F.col("places") - 1).alias("conflict"),
        F.greatest(F.lit(0), F.count("*") - 2).alias("old"))
    return per_key.agg(F.sum("dup").alias("duplicate_same_time_position"),
                       F.sum("conflict").alias("conflicting_positions_same_timestamp"),
                       F.sum("old").alias("older_positions_discarded"))


def contact_with_positions(ranked: DataFrame, key: str, at: str, fields: Sequence[str],
                           position_fields: Sequence[str]) -> DataFrame:
    """Rows ranked 1..2 to one contact: latest values over previous ones, plus a ranked positions array."""
    pos = F.struct(F.col("rank"), F.col(at), *position_fields)
    merged = [F.min_by(F.col(f), F.when(filled(ranked, f), F.col("rank"))).alias(f) for f in fields]
    out = ranked.groupBy(key).agg(*merged, F.array_sort(F.collect_list(pos)).alias("positions"))
    return (out.withColumn("position_count", F.size("positions"))
            .withColumn("latest_position", F.col("positions")[0])
            .withColumn("previous_position", F.get("positions", F.lit(1))))


def best_identity(df: DataFrame, key: str, fields: Sequence[str], seq: str) -> DataFrame:
    """Identity fields from the most complete record; the first of equals."""
    score = record_score(df.columns)
    return (df.withColumn("_score", score).groupBy(key)
            .agg(F.max_by(F.struct(*fields), F.struct(F.col("_score"), -F.col(seq))).alias("_b"))
            .select(key, "_b.*"))


def union_first_wins(groups: Sequence[DataFrame], key: Column, seq: str) -> DataFrame:
    """Union of groups; per identity the first group, then the first row, wins.

    Rows without an identity are told apart by name and place, so geometry-only rows survive.
    """
    out = None
    for number, group in enumerate(groups):
        tagged = group.withColumn("grp", F.lit(number))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    place = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("name", "latitude", "longitude") if c in out.columns])
    tagged = F.coalesce(F.concat(F.lit("id:"), key), F.concat(F.lit("at:"), place))
    kept = top_k(out.withColumn("dedupe_key", key).withColumn("_tagged", tagged), ["_tagged"], [F.col("grp"), F.col(seq)])
    return kept.drop("_tagged")
