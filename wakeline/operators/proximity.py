"""Tracks that loiter near seabed infrastructure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.times import time_chunk
from wakeline.operators.keyed import chunked_rank, near_runs, top_k
from wakeline.operators.spatial import feature_distance, near_lines, near_pairs, shapes


def assemble_tracks(history: DataFrame, current: DataFrame, key: str, at: str, since: Column, seq: str) -> DataFrame:
    """History plus current points since the cutoff, one per place (5 decimals) and time; history wins."""
    both = history.withColumn("_src", F.lit(0)).unionByName(current.withColumn("_src", F.lit(1)),
                                                            allowMissingColumns=True)
    usable = both.where((F.col(at) >= since) & F.col(key).isNotNull() & F.col("latitude").isNotNull()
                        & F.col("longitude").isNotNull())
    place = usable.withColumn("_la", F.round("latitude", 5)).withColumn("_lo", F.round("longitude", 5))
    first = F.min_by(F.struct(*both.columns), F.struct("_src", seq)).alias("_r")
    return place.groupBy(key, at, "_la", "_lo").agg(first).select("_r.*").drop("_src")


def number_points(track: DataFrame, key: str, at: str, seq: str, params: P.ProximityParams) -> DataFrame:
    """``track_seq``: position of each point within its track."""
    return chunked_rank(track, [key], time_chunk(F.col(at), params.chunk_seconds), [F.col(at), F.col(seq)],
                        "track_seq")


def near_points(track: DataFrame, segs: DataFrame, key: str, at: str, params: P.ProximityParams,
                extra=("sog", "timestamp_valid"), feature_cols=("infrastructure_type",)) -> DataFrame:
    """Numbered track points within the close band of a feature.

    Far points only matter by breaking a run, and a gap in ``track_seq`` says the same, so the
    whole track is never joined with the feature.
    """
    cols = [key, "track_seq", at, "latitude", "longitude", *extra]
    return near_pairs(track.select(*cols), segs, params.close_nm, params.cell_degrees, cols, list(feature_cols))


def near_shapes(track: DataFrame, lines: DataFrame, key: str, at: str, params: P.ProximityParams,
                extra=("sog", "timestamp_valid")) -> DataFrame:
    """``near_points`` for the lines of ``spatial.shapes``."""
    cols = [key, "track_seq", at, "latitude", "longitude", *extra]
    return near_lines(track.select(*cols), lines, params.close_nm, params.cell_degrees, cols)


def track_candidates(track: DataFrame, segs: DataFrame, key: str, params: P.ProximityParams, feature: str = "feature_id") -> DataFrame:
    """(track, feature) that come within the contextual distance anywhere."""
    members, lines = shapes(segs, feature)
    places = track.select(key, "latitude", "longitude").distinct()
    met = near_lines(places, lines, params.contextual_nm, params.cell_degrees, [key])
    return met.join(members, "shape").select(key, feature)


def signals(low_speed: Column, dwell: Column, entries: Column, params: P.ProximityParams) -> Column:
    return F.array_compact(F.array(
        F.when(low_speed >= params.minimum_near_points, "low_speed_near_infrastructure"),
        F.when(dwell >= params.minimum_dwell_minutes, "extended_presence_near_infrastructure"),
        F.when(entries >= params.repeated_entries, "repeated_entries_into_close_band")))


def context_signals(behaviour: Column, valid_ratio: Column, categories: Column | None = None) -> Column:
    """The behaviour signals with the event kind before and what qualifies them after."""
    known = F.lit(False) if categories is None else F.coalesce(
        F.arrays_overlap(categories, F.array(*[F.lit(c) for c in P.TRACK_CONTEXT_CATEGORIES])), F.lit(False))
    return F.concat(F.array(F.lit("critical_infrastructure_proximity")), behaviour, F.array_compact(F.array(
        F.when(known, "voi_or_watchlist_context"), F.when(valid_ratio < 1.0, "timestamp_quality_limited"))))


def with_context(summary: DataFrame, vessels: DataFrame, key: str) -> DataFrame:
    """Adds ``context_signals`` from the vessels' categories (one row per key: key, categories)."""
    known = vessels.select(F.col(key), F.col("categories").alias("_cats"))
    return (summary.join(known, key, "left")
            .withColumn("context_signals", context_signals(F.col("signals"), F.col("valid_ratio"), F.col("_cats"))).drop("_cats"))


def event_level(min_distance: Column, n_signals: Column, params: P.ProximityParams) -> Column:
    strong = (min_distance <= params.immediate_nm) | ((min_distance <= params.close_nm) & (n_signals >= 2))
    return F.when(strong, "elevated").otherwise("review")


def event_confidence(near: Column, valid_ratio: Column) -> Column:
    return F.when((near >= 3) & (valid_ratio >= 0.67), "medium").otherwise("low_medium")


def summarise(near: DataFrame, key: str, at: str, params: P.ProximityParams, feature: str = "feature_id",
              feature_cols=("infrastructure_type",)) -> DataFrame:
    """Per track and feature: counts, closest point, entries, longest stay, signals, level, confidence."""
    keys = [key, feature]
    slow = F.col("sog") <= params.low_speed_knots
    stats = near.groupBy(*keys, *feature_cols).agg(
        F.count("*").alias("near_points"), F.count_if(slow).alias("low_speed_points"),
        F.count_if(F.coalesce("timestamp_valid", F.lit(True))).alias("valid_time_points"),
        F.min(F.struct("distance_nm", "track_seq", F.col(at).alias("at"), "latitude", "longitude")).alias("closest"))
    runs = near_runs(near, keys, time_chunk(F.col(at), params.chunk_seconds), "track_seq", at,
                     params.maximum_gap_minutes)
    out = stats.join(runs, keys).withColumn("minimum_distance_nm", F.col("closest.distance_nm"))
    out = out.withColumn("signals", signals(F.col("low_speed_points"), F.col("dwell_minutes"), F.col("entries"), params))
    return (out.withColumn("valid_ratio", F.col("valid_time_points") / F.col("near_points"))
            .withColumn("level", event_level(F.col("minimum_distance_nm"), F.size("signals"), params))
            .withColumn("confidence", event_confidence(F.col("near_points"), F.col("valid_ratio"))))


def summarise_features(track: DataFrame, segs: DataFrame, key: str, at: str, params: P.ProximityParams,
                       feature: str = "feature_id", feature_cols=("infrastructure_type",)) -> DataFrame:
    """``summarise`` of a numbered track against features: a shape is summarised once for all features drawn like it."""
    members, lines = shapes(segs, feature, feature_cols)
    found = summarise(near_shapes(track, lines, key, at, params), key, at, params, "shape", ())
    return found.join(members, "shape").drop("shape")


def proximity_events(track: DataFrame, segs: DataFrame, key: str, at: str, seq: str,
                     params: P.ProximityParams = P.ProximityParams(), feature_cols=("infrastructure_type",)
                     ) -> DataFrame:
    """Events: track and feature pairs with at least one behaviour signal, best few per vessel."""
    members, lines = shapes(segs, "feature_id", feature_cols)
    near = near_shapes(number_points(track, key, at, seq, params), lines, key, at, params)
    found = summarise(near, key, at, params, "shape", ()).where(F.size("signals") > 0)
    counted = track.groupBy(key).agg(F.count("*").alias("track_points"),
                                     F.max_by(F.struct("latitude", "longitude"), F.struct(at, seq)).alias("latest"))
    out = found.join(counted, key)
    last = out.select(key, "shape", "latest.latitude", "latest.longitude")
    latest = feature_distance(last, lines, [key], "shape").withColumnRenamed("distance_nm", "latest_distance_nm")
    events = out.join(latest, [key, "shape"]).join(members, "shape").drop("shape")
    return top_k(events, [key], [(F.col("level") != "elevated").asc(), F.col("minimum_distance_nm").asc(),
                                 F.col("feature_id").asc()], params.max_events_per_vessel, rank="event_rank")


def order_events(events: DataFrame) -> DataFrame:
    return events.orderBy((F.col("level") != "elevated").asc(), F.col("minimum_distance_nm").asc())


def event_summary(events: DataFrame, maximum_delta: int = 5) -> DataFrame:
    counted = events.agg(F.count("*").alias("event_count"),
                         F.count_if(F.col("level") == "elevated").alias("elevated_count"),
                         F.count_if(F.col("level") == "review").alias("review_count"))
    return counted.withColumn("suggested_delta", F.least(
        F.lit(maximum_delta), F.col("elevated_count") * 2 + F.least(F.lit(2), F.col("review_count"))))
