"""Counts, fingerprints and health rows about a run's inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import identity
from wakeline.functions.times import time_chunk
from wakeline.operators.keyed import chunked_sum, within


def watchlist_audit(watch: DataFrame, line: str = "line_no") -> DataFrame:
    """One row: rows, unique keys, duplicate rows, missing keys, test rows, sanction and shadow rows."""
    hay = F.lower(F.concat_ws(" ", "name", "notes", "source_list"))
    marked = watch.withColumn("_key", identity.id_dedupe()).withColumn("_test", hay.rlike("|".join(P.TEST_WORDS)))
    per = marked.groupBy("_key").agg(
        F.count("*").alias("n"), F.count_if("_test").alias("t"), F.count_if("track_sanctions").alias("s"),
        F.count_if("track_shadowfleet").alias("f"))
    known = F.col("_key").isNotNull()
    return per.agg(
        F.sum("n").alias("rows"), F.count_if(known).alias("unique_identity_keys"),
        F.sum(F.when(known, F.col("n") - 1).otherwise(0)).alias("duplicate_rows"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("missing_identity_rows"),
        F.sum("t").alias("test_rows"), F.sum("s").alias("track_sanctions_rows"),
        F.sum("f").alias("track_shadowfleet_rows"))


def duplicate_lines(watch: DataFrame, line: str = "line_no") -> DataFrame:
    """Every row after the first of its key, with the first row's line."""
    keyed = watch.withColumn("key", identity.id_dedupe()).where("key IS NOT NULL")
    first = keyed.groupBy("key").agg(F.min(line).alias("duplicates_line"), F.count("*").alias("_n")).where("_n > 1")
    return keyed.join(first, "key").where(F.col(line) > F.col("duplicates_line")).select(
        F.col(line).alias("line"), "duplicates_line", "key")


def fingerprint(df: DataFrame, *columns: str) -> DataFrame:
    """Order-independent fingerprint of a row set: the row hashes are summed, then hashed.

    The sum is a partial aggregate, so the index is never collected; any change of a row changes it.
    NULL and text are told apart, and a separator inside a text is escaped, so no two rows look alike.
    """
    coded = [F.coalesce(F.concat(F.lit("v"), F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")),
                                                       F.lit("\u001f"), F.lit("\\u"))), F.lit("n")) for c in columns]
    digest = F.sha2(F.concat_ws("\u001f", *coded), 256)
    piece = lambda i: F.sum(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast(
        "decimal(38,0)").cast("string")
    sums = df.agg(F.count("*").alias("rows"), *[piece(i).alias(f"s{i}") for i in range(4)])
    return sums.select("rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), "s0", "s1", "s2", "s3"), 256
                                      ).alias("fingerprint"))


def source_ages(df: DataFrame, provider: str, at: str, as_of: Column) -> DataFrame:
    """Source list and age of the newest data."""
    return df.agg(F.array_join(F.array_sort(F.collect_set(provider)), ",").alias("sources"), F.max(at).alias("newest"),
                  F.round((F.unix_micros(as_of) - F.unix_micros(F.max(at))) / 3.6e9, 2).alias("age_hours"))


def run_health(status: DataFrame) -> DataFrame:
    """Health and coverage mode from a status table (provider, included, stale, failed, capped, matches)."""
    primary = F.col("included") & (F.col("provider") == "aisstream")
    other = F.col("included") & (F.col("provider") != "aisstream")
    row = status.agg(
        F.bool_or("failed").alias("any_failed"), F.bool_or("capped").alias("any_capped"),
        F.sum("matches").alias("matches"), F.count_if("included").alias("included"),
        F.bool_or(F.col("included") & F.col("stale")).alias("stale"), F.bool_or(primary).alias("p"),
        F.bool_or(other).alias("o"))
    return row.select(
        F.when(F.col("included") == 0, "no_data").when(
            F.col("any_failed") | F.col("any_capped") | (F.col("matches") == 0), "degraded").otherwise("ok"
                                                                                                   ).alias("health"),
        F.when(F.col("p") & F.col("o"), "mixed_regional_and_primary").when(F.col("p"), "primary_only")
        .otherwise("regional_only").alias("coverage_mode"), "stale", "included", "matches")


def rank_newest(df: DataFrame, at: str, seq: str, cap: int | None = None, chunk_seconds: int = 3600) -> DataFrame:
    """Every row with ``newest_rank`` (newest first, then ``seq``) and whether it is within the optional cap."""
    chunk = F.coalesce(-time_chunk(F.col(at), chunk_seconds), F.lit(2 ** 62))
    coarse = F.floor(F.col("_chunk") / 4096)
    ranked = chunked_sum(df, [], chunk, [F.col(at).desc_nulls_last(), F.col(seq)], F.lit(1).cast("bigint"), "newest_rank", coarse)
    return ranked.withColumn("within_limit", within("newest_rank", cap))
