"""As-of reads, the common watermark and the canonical row per vessel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.tables import fixed_table
from wakeline.functions.times import minutes_between
from wakeline.operators.keyed import CHUNK, carry_around, top_k


def common_watermark(rows: DataFrame, at: str, provider: str = "provider",
                     slow: str = P.SnapshotParams().slow_source) -> DataFrame:
    """One row: the slow source's newest time, floored to the hour."""
    return rows.where(F.col(provider) == slow).agg(F.date_trunc("hour", F.max(at)).alias("snapshot_at"))


def pick_as_of(rows: DataFrame, snapshot_at: Column, max_age_hours: Column, at: str, seq: str,
               keys=("provider", "identity_key")) -> DataFrame:
    """Per identity the latest row at or before the snapshot within its age limit, with age and previous row."""
    age = (F.unix_micros(snapshot_at) - F.unix_micros(at)) / 3.6e9
    eligible = rows.where((F.col(at) <= snapshot_at) & (age <= max_age_hours))
    ranked = top_k(eligible, list(keys), [F.col(at).desc(), F.col(seq).desc()], 2, rank="_n")
    row = F.struct(*[c for c in rows.columns if c not in keys])
    prev = F.struct(F.col(at).alias("observed_at"), "latitude", "longitude")
    picked = ranked.groupBy(*keys).agg(F.max(F.when(F.col("_n") == 1, row)).alias("_row"),
                                       F.max(F.when(F.col("_n") == 2, prev)).alias("previous_position"))
    out = picked.select(*keys, "_row.*", "previous_position")
    return out.withColumn("age_at_snapshot_minutes", F.round(minutes_between(snapshot_at, F.col(at)), 1))


def _by_provider(table: dict, default, provider: str = "provider") -> Column:
    out = F.lit(default)
    for name, value in table.items():
        out = F.when(F.col(provider) == name, F.lit(value)).otherwise(out)
    return out


def max_age(params: P.SnapshotParams = P.SnapshotParams()) -> Column:
    return _by_provider(params.max_age_hours, params.default_max_age_hours)


def canonical(rows: DataFrame, key: str = "identity_key", params: P.SnapshotParams = P.SnapshotParams()) -> DataFrame:
    """Best provider row per identity: youngest, valid time, exact position, provider rank."""
    score = F.struct(F.col("age_at_snapshot_minutes"),
                     F.when(F.coalesce("timestamp_valid", F.lit(True)), 0).otherwise(1).alias("t"),
                     F.when(F.coalesce("position_is_exact", F.lit(True)), 0).otherwise(1).alias("e"),
                     _by_provider(params.provider_rank, params.default_rank).alias("p"), F.col("provider"))
    row = F.struct(*[c for c in rows.columns if c != key])
    return rows.groupBy(key).agg(
        F.min_by(row, score).alias("_row"), F.array_sort(F.collect_set("provider")).alias("provider_candidates"),
        F.count("*").alias("provider_candidate_count")).select(
        key, "_row.*", "provider_candidates", "provider_candidate_count")


def coverage_state(coverage: DataFrame, selected: DataFrame, snapshot_at: Column,
                   params: P.SnapshotParams = P.SnapshotParams()) -> DataFrame:
    """Per mandatory provider: coverage point, range and readiness state."""
    age = F.make_interval(hours=_by_provider(params.max_age_hours, params.default_max_age_hours).cast("int"))
    tolerance = F.make_interval(hours=_by_provider(params.future_tolerance_hours, 0.0).cast("int"))
    point = F.when((F.col("coverage_at") <= snapshot_at + tolerance) & (F.col("coverage_at") >= snapshot_at - age),
                   F.col("coverage_at"))
    ranges = coverage.groupBy("provider").agg(
        F.max(point).alias("coverage_point"), F.min("coverage_at").alias("coverage_min"),
        F.max("coverage_at").alias("coverage_max"))
    counts = selected.groupBy("provider").agg(F.count("*").alias("selected_contacts"))
    mandatory = fixed_table(coverage.sparkSession, ("provider",), [(p,) for p in params.mandatory])
    out = mandatory.join(ranges, "provider", "left").join(counts, "provider", "left")
    chosen = F.coalesce("selected_contacts", F.lit(0))
    state = (F.when(F.col("coverage_point").isNull() & (F.col("coverage_min") > snapshot_at), "warming_up")
             .when(F.col("coverage_point").isNull(), "missing_at_watermark")
             .when(chosen == 0, "ready_no_retained_contacts").otherwise("ready"))
    return out.withColumn("selected_contacts", chosen).withColumn("state", state)


def is_ready(state: Column) -> Column:
    return state.isin("ready", "ready_no_retained_contacts")


def coverage_time(rows: DataFrame, envelope: list[str], observed: str, key: str = "provider") -> DataFrame:
    """Per source: first usable envelope time, else the newest observation, with its basis."""
    per = rows.groupBy(key).agg(*[F.max(c).alias(c) for c in envelope], F.max(observed).alias("_obs"),
                                F.count("*").alias("contact_count"))
    basis = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in envelope],
                       F.when(F.col("_obs").isNotNull(), F.lit("max_normalized_observation")))
    return per.select(key, F.coalesce(*envelope, "_obs").alias("coverage_at"), basis.alias("coverage_basis"),
                      "contact_count")


def provider_ranges(rows: DataFrame, at: str, key: str = "provider") -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def bracketing(rows: DataFrame, scene_at: Column, key: str, at: str, score: Column, seq: str, k: int = 4) -> DataFrame:
    """Nearest ``k`` distinct times before (or at) and after the scene per vessel; ``side`` and ``rank`` added."""
    tagged = rows.withColumn("side", F.when(F.col(at) <= scene_at, "before").otherwise("after")).withColumn(
        "_score", score)
    best = F.max_by(F.struct(*[c for c in tagged.columns if c != "_score"]),
                    F.struct(F.col("_score"), -F.col(seq))).alias("_r")
    single = tagged.groupBy(key, at).agg(best).select("_r.*")
    gap = F.abs(F.unix_micros(at) - F.unix_micros(scene_at))
    return top_k(single, [key, "side"], [gap.asc()], k, rank="rank")


def nearest_times(both: DataFrame, keys: Sequence[str], at: str, side: str, rows: str, before: str = "before",
                  after: str = "after", chunk: Column | None = None, place: Sequence[str] = (), single: bool = False) -> DataFrame:
    """Per row the newest time at or before it and the oldest after it that rows of side 0 have under the same keys.

    Input: both sides as one frame, so that they go through one ordered pass and nothing is paired all-with-all; rows
    of side 0 sort first. The times are structs of the time and the joined lists ``rows`` of the side-0 rows at it;
    ``single`` says that there is one such row a time. ``chunk`` and ``place`` as in ``carry_around``; the chunk goes
    by the time.
    """
    part = [] if chunk is None else [CHUNK]
    held = both if chunk is None else both.withColumn(CHUNK, chunk)
    first, listed = F.col(side) == 0, F.col(rows)
    if not single:  # each time's list is carried by one of its rows
        same = Window.partitionBy(*place, *keys, *part, at).orderBy(side)
        whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        held = held.withColumns({"_number": F.row_number().over(same), "_lists": F.collect_list(F.when(first, listed)).over(whole)})
        first, listed = first & (F.col("_number") == 1), F.flatten("_lists")
    held = held.withColumn("_held", F.when(first, F.struct(F.col(at).alias("at"), listed.alias("rows")))).drop("_number", "_lists")
    out = carry_around(held, keys, chunk if chunk is None else F.col(CHUNK), [at, side], F.col("_held"), before, after, place)
    return out.drop("_held")
