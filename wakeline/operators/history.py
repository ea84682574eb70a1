"""Bounded, deduplicated history: compaction, day shards, byte budgets and balanced sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.times import time_chunk
from wakeline.operators.filters import retention_reject
from wakeline.operators.keyed import chunked_rank, ranged_sums, top_k, within


def line_bytes(*columns: str) -> Column:
    """Size of a row as one JSON line."""
    return F.octet_length(F.to_json(F.struct(*columns))) + 1


def newest_per_key(rows: DataFrame, key: str, at: str, seq: str) -> DataFrame:
    """Newest row per key, then the highest ingest order; one partial aggregation."""
    row = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.max_by(row, F.struct(at, seq)).alias("_r")).select("_r.*")


def compact(rows: DataFrame, key: str, at: str, seq: str, as_of: Column, policy: P.HistoryPolicy = P.HistoryPolicy()
            ) -> DataFrame:
    """Rows inside the retention window, newest per key."""
    reject = retention_reject(F.col(at), as_of, policy.retention_days, policy.future_tolerance_hours)
    return newest_per_key(rows.where(reject.isNull()), key, at, seq)


def compact_stats(rows: DataFrame, key: str, at: str, as_of: Column, policy: P.HistoryPolicy = P.HistoryPolicy()
                  ) -> DataFrame:
    """One row of compaction counters."""
    reject = retention_reject(F.col(at), as_of, policy.retention_days, policy.future_tolerance_hours)
    marked = rows.withColumn("_why", F.coalesce(reject, F.lit("kept")))
    per_key = marked.groupBy("_why", key).agg(F.count("*").alias("n"))
    at_reason = lambda why: F.coalesce(F.sum(F.when(F.col("_why") == why, F.col("n"))), F.lit(0))
    return per_key.agg(
        F.sum("n").alias("source_rows"), at_reason("missing_timestamp").alias("missing_timestamp_rows"),
        at_reason("outside_window").alias("outside_window_rows"),
        at_reason("future_timestamp").alias("future_timestamp_rows"),
        F.sum(F.when(F.col("_why") == "kept", F.col("n") - 1).otherwise(0)).alias("duplicate_rows"),
        F.count_if(F.col("_why") == "kept").alias("kept_rows"))


def assign_parts(rows: DataFrame, at: str, key: str, size: Column, max_bytes: int, close: bool = False) -> DataFrame:
    """Adds ``date_utc`` and ``part``: rows of a day in (time, key) order, no part above ``max_bytes``.

    Rows up to half the limit are cut on the day's running byte sum, which runs over ranges of rows, in
    steps of half the limit: a part starts inside its step and its last row ends at most half the limit
    later, so it never exceeds the limit. Each larger row is a part of its own, after those. A single
    row above the limit fails the job. With ``close`` the steps are the limit less the day's widest row
    of those, so parts of narrow rows are almost full.
    """
    sized = rows.withColumn("date_utc", F.to_date(at)).withColumn("line_bytes", size)
    sized = sized.withColumn("line_bytes", F.when(F.col("line_bytes") > max_bytes, F.raise_error(
        F.lit("a single history row exceeds the shard limit")).cast("int")).otherwise(F.col("line_bytes")))
    large = F.col("line_bytes") * 2 > max_bytes
    # Small rows add their bytes, large ones a number.
    summed = ranged_sums(sized, ["date_utc"], [F.col(at), F.col(key)], {
        "_run": F.when(large, 0).otherwise(F.col("line_bytes")).cast("bigint"), "_large": large.cast("bigint")})
    start = F.col("_run") - F.col("line_bytes")
    small = summed.where(~large).groupBy("date_utc").agg(F.max("line_bytes").alias("_widest"), F.max(start).alias("_last"))
    room = F.lit(max_bytes) - F.col("_widest") if close else F.lit(max_bytes / 2)
    part = F.when(large, F.coalesce(F.floor(F.col("_last") / room) + 1, F.lit(0)) + F.col("_large")).otherwise(F.floor(start / room) + 1)
    return summed.join(small, "date_utc", "left").withColumn("part", part.cast("int")).drop("_run", "_large", "_widest", "_last")


def shard_manifest(parts: DataFrame, at: str) -> DataFrame:
    """Rows, bytes, oldest and newest per part, plus a total row (part and date NULL)."""
    return parts.rollup("date_utc", "part").agg(
        F.count("*").alias("rows"), F.sum("line_bytes").alias("bytes"), F.min(at).alias("oldest"),
        F.max(at).alias("newest")).where("part IS NOT NULL OR date_utc IS NULL")


def newest_within_budget(rows: DataFrame, at: str, key: str, size: Column, budget: int | None = None) -> DataFrame:
    """Every row with the bytes of it and all newer ones, and whether they are within the optional budget."""
    sized = rows.withColumn("line_bytes", size.cast("bigint"))
    summed = ranged_sums(sized, [], [F.col(at).desc(), F.col(key).desc()], {"running_bytes": F.col("line_bytes")})
    return summed.withColumn("within_limit", within("running_bytes", budget))


def _midpoint_place(position: Column, length: Column) -> Column:
    """(depth, left-to-right place) of an interior position in repeated halving of 1..length-2."""
    start = F.struct(F.lit(1).cast("bigint").alias("lo"), (length - 2).cast("bigint").alias("hi"),
                     F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("place"), F.lit(False).alias("done"))

    def step(acc, _i):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("bigint")
        here = acc["done"] | (position == mid)
        left = position < mid
        return F.struct(
            F.when(here | left, acc["lo"]).otherwise(mid + 1).alias("lo"),
            F.when(here | ~left, acc["hi"]).otherwise(mid - 1).alias("hi"),
            F.when(here, acc["depth"]).otherwise(acc["depth"] + 1).alias("depth"),
            F.when(here, acc["place"]).otherwise(acc["place"] * 2 + F.when(left, 0).otherwise(1)).cast("bigint"
                                                                                                     ).alias("place"),
            here.alias("done"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(48)), start, step, lambda acc: F.struct(acc["depth"], acc["place"]))


def sampling_order(rows: DataFrame, identity: str, at: str, key: str, priority: str, chunk_seconds: int = 86400
                   ) -> DataFrame:
    """Adds ``round`` and the identity's sort columns: latest of each, earliest of each, then midpoints."""
    order = [F.col(at), F.col(key)]
    placed = chunked_rank(rows, [identity], time_chunk(F.col(at), chunk_seconds), order, "_n")
    groups = rows.groupBy(identity).agg(F.count("*").alias("_len"), F.max(at).alias("id_latest"),
                                        F.bool_or(F.coalesce(priority, F.lit(False))).alias("id_priority"))
    df = placed.join(groups, identity).withColumn("_pos", F.col("_n") - 1)
    interior = (F.col("_pos") > 0) & (F.col("_pos") < F.col("_len") - 1)
    df = df.withColumn("_m", F.when(interior, _midpoint_place(F.col("_pos"), F.col("_len"))))
    mids = df.where("_m IS NOT NULL").withColumn("_depth", F.col("_m.depth")).withColumn("_place", F.col("_m.place"))
    shift = F.greatest(F.lit(0), F.col("_depth") - 12).cast("int")
    chunk = F.col("_depth").cast("bigint") * 8192 + F.floor(F.col("_place") / F.pow(F.lit(2.0), shift)).cast("bigint")
    mids = chunked_rank(mids, [identity], chunk, [F.col("_depth"), F.col("_place")], "_turn").withColumn(
        "round", F.col("_turn") + 1).drop("_turn", "_depth", "_place")
    ends = df.where("_m IS NULL").withColumn(
        "round", F.when(F.col("_pos") == F.col("_len") - 1, 0).otherwise(1).cast("bigint"))
    return ends.unionByName(mids).drop("_n", "_len", "_pos", "_m")


def balanced_sample(rows: DataFrame, identity: str, at: str, key: str, priority: str, size: Column, budget: int
                    ) -> DataFrame:
    """Every row, with ``sampled``: whether it is in the identity-balanced sample under a byte budget.

    Rows are taken in sampling order whenever they still fit. A pass over running sums takes the
    longest prefix that fits; what follows can only hold rows not larger than the room left, so the
    next pass drops all larger ones. The room shrinks below the smallest row after few passes, and
    each pass is a distributed job over (order, bytes) only.
    """
    from wakeline.session import cut_lineage

    ordered = sampling_order(rows.withColumn("line_bytes", size.cast("bigint")), identity, at, key, priority)
    small = cut_lineage(ordered.select("round", F.col("id_priority"), F.col("id_latest"), identity, key, "line_bytes"))
    rank = [F.col("round"), F.col("id_priority").desc(), F.col("id_latest").desc(), F.col(identity)]
    remaining, room, taken = small, budget, None
    while True:
        run = cut_lineage(ranged_sums(remaining.where(F.col("line_bytes") <= room), [], rank, {"run": F.col("line_bytes")}))
        fits = run.where(F.col("run") <= room)
        stats = run.agg(F.max(F.when(F.col("run") <= room, F.col("run"))).alias("used"),
                        F.count_if(F.col("run") > room).alias("left")).first()
        picked = fits.select(identity, key, "round")
        taken = picked if taken is None else taken.unionByName(picked)
        if not stats["left"] or stats["used"] is None:
            break
        room -= stats["used"]
        remaining = run.where(F.col("run") > stats["used"]).drop("run")
    chosen = taken.select(identity, key).distinct().withColumn("sampled", F.lit(True))
    return (rows.withColumn("line_bytes", size.cast("bigint")).join(chosen, [identity, key], "left")
            .withColumn("sampled", F.coalesce("sampled", F.lit(False))))


def track_points(rows: DataFrame, key: str, at: str, since: Column, n: int | None = None,
                 chunk_seconds: int = 86400) -> DataFrame:
    """Distinct points per identity since the cutoff with their rank by age and role; the last ``n`` if that is given."""
    usable = rows.where((F.col(at) >= since) & F.col(key).isNotNull())
    distinct = usable.dropDuplicates([key, at, "latitude", "longitude"])
    order = [F.col(at).desc(), F.col("latitude").desc(), F.col("longitude").desc()]
    last = (chunked_rank(distinct, [key], -time_chunk(F.col(at), chunk_seconds), order, "age_rank") if n is None
            else top_k(distinct, [key], order, n, rank="age_rank"))
    return last.withColumn("timeline_role", F.when(F.col("age_rank") == 1, "latest_in_window").otherwise(
        "historical_point"))


def track_lines(points: DataFrame, key: str, at: str, vertices: int = 1000) -> DataFrame:
    """(key, piece, path): the whole track of every identity with at least two points, oldest vertex of a path first.

    A track is cut into pieces of up to ``vertices`` vertices, at least two; piece 0 is the newest. A piece ends at the
    vertex the next newer one begins at.
    """
    if vertices < 2:
        raise ValueError("a piece of a track has at least two vertices")
    step, place = vertices - 1, F.col("age_rank").cast("bigint") - 1
    piece = F.floor(place / step)
    # The last vertex of a piece, by age, is the first of the next one.
    pieces = F.when((place > 0) & (place % step == 0), F.array(piece - 1, piece)).otherwise(F.array(piece))
    vertex = F.struct((-place).alias("newness"), F.col(at), F.col("longitude"), F.col("latitude"))
    lines = (points.select(key, F.explode(pieces).alias("piece"), vertex.alias("vertex")).groupBy(key, "piece")
             .agg(F.array_sort(F.collect_list("vertex")).alias("path")).where(F.size("path") >= 2))
    return lines.withColumn("path", F.transform("path", lambda v: F.struct(v[at].alias(at), v["longitude"].alias("longitude"), v["latitude"].alias("latitude"))))


def previous_step(positions: DataFrame, key: str, at: str, seq: str, chunk_seconds: int = 86400) -> DataFrame:
    """Each position with its predecessor and the step distance in nm."""
    from wakeline.functions import geo
    from wakeline.operators.keyed import carry_last

    prev = carry_last(positions, [key], time_chunk(F.col(at), chunk_seconds), [at, seq],
                      {"prev": F.struct(F.col(at).alias("at"), "longitude", "latitude")}, inclusive=False)
    return prev.withColumn("step_nm", F.round(geo.haversine_nm(
        F.col("prev.longitude"), F.col("prev.latitude"), F.col("longitude"), F.col("latitude")), 3))


def validate(rows: DataFrame, key: str, at: str, as_of: Column, policy: P.HistoryPolicy = P.HistoryPolicy()
             ) -> DataFrame:
    """One row of violation counts: missing time, outside the window, future, repeated keys, rows."""
    early = as_of - F.make_dt_interval(F.lit(policy.retention_days), F.lit(0), F.lit(5))
    late = as_of + F.make_dt_interval(F.lit(0), F.lit(policy.future_tolerance_hours))
    per_key = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.col(at).isNull()).alias("m"), F.count_if(F.col(at) < early).alias("e"),
        F.count_if(F.col(at) > late).alias("f"))
    return per_key.agg(F.sum("n").alias("rows"), F.sum("m").alias("missing_timestamp"),
                       F.sum("e").alias("outside_window"), F.sum("f").alias("future"),
                       F.count_if(F.col("n") > 1).alias("duplicate_keys"))


def require_valid(violations: DataFrame) -> DataFrame:
    """Fails the job when any violation count is not zero."""
    bad = F.col("missing_timestamp") + F.col("outside_window") + F.col("future") + F.col("duplicate_keys")
    return violations.withColumn("ok", F.when(bad > 0, F.raise_error(F.concat(
        F.lit("history violates its policy: "), bad.cast("string"))).cast("boolean")).otherwise(F.lit(True)))



def subset_violations(inner: DataFrame, outer: DataFrame, key: str) -> DataFrame:
    """Keys of ``inner`` that ``outer`` lacks."""
    return inner.select(key).distinct().join(outer.select(key).distinct(), key, "left_anti")


def disjoint_violations(parts: DataFrame, key: str, part: str = "part") -> DataFrame:
    """Keys present in more than one shard."""
    return parts.groupBy(key).agg(F.count_distinct("date_utc", part).alias("shards")).where("shards > 1")
