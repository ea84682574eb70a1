"""Row filters and reject accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo
from wakeline.functions.text import inactive_or_test, let, norm_digits, parse_float, present
from wakeline.functions.times import parse_archive_dt


def drop_inactive(df: DataFrame, active: str, *texts: str) -> DataFrame:
    return df.where(~inactive_or_test(active, *texts))


def archive_reject_reason(column_count: Column | None = None) -> Column:
    """First failing check of a daily-archive row, NULL when the row is good."""
    facts = F.struct(
        (F.lit(True) if column_count is None else column_count == len(P.ARCHIVE_COLUMNS)).alias("whole"),
        F.lower(present("timestamp")).alias("stamp"), parse_archive_dt("timestamp").alias("dt"),
        F.regexp_replace(F.lower(present("type_of_mobile")), r"\s+", " ").alias("mobile"),
        F.length(norm_digits("mmsi")).alias("digits"), parse_float("latitude").alias("lat"),
        parse_float("longitude").alias("lon"))

    # The facts are worked out once per row, also where Spark pushes the test into a filter.
    return let(facts, lambda f: (
        F.when(~f["whole"], "wrong_column_count")
        .when(f["stamp"] == "timestamp", "header")
        .when(~F.coalesce(f["mobile"].isin(*P.VESSEL_MOBILE_TYPES), F.lit(False)), "non_vessel_mobile_type")
        .when(F.coalesce(f["digits"], F.lit(0)) != 9, "invalid_mmsi")
        .when(f["dt"].isNull(), "invalid_timestamp")
        .when(~geo.valid_position(f["lat"], f["lon"], reject_origin=True), "invalid_position")))


def reject_counts(df: DataFrame, reason: Column, kept: str = "kept") -> DataFrame:
    return df.groupBy(F.coalesce(reason, F.lit(kept)).alias("reason")).agg(F.count("*").alias("n"))


def retention_reject(dt: Column, as_of: Column, days: int, future_hours: int) -> Column:
    return (F.when(dt.isNull(), "missing_timestamp")
            .when(dt < as_of - F.make_dt_interval(F.lit(days)), "outside_window")
            .when(dt > as_of + F.make_dt_interval(F.lit(0), F.lit(future_hours)), "future_timestamp"))


def in_scene_window(at: Column, scene_at: Column, minutes: int) -> Column:
    """Inside the scene's window and on the scene's day."""
    pad = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    return at.between(scene_at - pad, scene_at + pad) & (F.to_date(at) == F.to_date(scene_at))


def guard_radius_nm(sog: Column, gap_hours: Column, params: P.MatchParams) -> Column:
    known = sog.between(0, params.maximum_sog_knots)
    speed = F.when(known, F.least(F.lit(params.maximum_sog_knots), sog + 5.0)).otherwise(params.unknown_speed_knots)
    return params.maximum_distance_m / 1852.0 + speed * gap_hours + 1.0


def inside_guard(lon, lat, west, south, east, north, sog, gap_hours, params: P.MatchParams) -> Column:
    """Inside the scene box grown by what the vessel could cover in the time gap."""
    box = geo.expand_bbox(west, south, east, north, guard_radius_nm(sog, gap_hours, params))
    return geo.in_box(lon, lat, *box)


def ttl_status(df: DataFrame, provider: str, generated_at: str, as_of: Column,
               ttl: P.ProviderTtl = P.ProviderTtl()) -> DataFrame:
    """Age, stale flag (beyond soft TTL) and included flag (within hard TTL) per provider row."""
    def lookup(table: dict) -> Column:
        out = F.lit(None).cast("double")
        for name, hours in table.items():
            out = F.when(F.col(provider) == name, F.lit(float(hours))).otherwise(out)
        return out

    age = F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros(F.col(generated_at).cast("timestamp"))) / 3.6e9)
    return (df.withColumn("age_hours", F.round(age, 2))
            .withColumn("stale", age > lookup(ttl.soft)).withColumn("included", age <= lookup(ttl.hard)))


def publish_known(df: DataFrame, categories: str = "categories", known: str = "known_voi_match") -> DataFrame:
    """Known matches only, categories cut to the published list, empty ones dropped."""
    allowed = F.array(*[F.lit(c) for c in P.KNOWN_CATEGORIES])
    kept = F.array_sort(F.array_intersect(F.col(categories), allowed))
    return df.where(F.col(known)).withColumn(categories, kept).where(F.size(categories) > 0)


def map_layers(categories: Column, flags: dict[str, Column], mmsi: Column, priority: Column) -> Column:
    """Names of the map layers a snapshot row belongs to."""
    has = lambda c: F.array_contains(categories, c)
    flag = lambda n: F.coalesce(flags.get(n, F.lit(False)), F.lit(False))
    shown = priority | flag("known_voi_match") | F.arrays_overlap(
        categories, F.array(*[F.lit(c) for c in P.DISPLAY_VOI_CATEGORIES]))
    for name in ("sanctioned", "shadow_fleet", "false_flag", "behavioral_voi", "from_russia_confirmed"):
        shown = shown | flag(name)
    layers = {
        "vessel_positions": shown,
        "neutral_tanker_context": (flag("neutral_tanker_context") | has("neutral_tanker_context")) & ~shown,
        "sanctions_shadowfleet": flag("sanctioned") | flag("shadow_fleet") | has("sanctions_shadowfleet")
        | has("shadowfleet"),
        "watchlist": flag("known_voi_match") | has("watchlist"),
        "falseflag_interest": flag("false_flag") | has("falseflag_interest"),
        "false_flag_watch": has("false_flag_watch"),
        "russian_mmsi": has("russian_mmsi") | F.coalesce(mmsi.startswith("273"), F.lit(False)),
        "recent_russian_portcall_10d": flag("from_russia_confirmed") | has("recent_russian_portcall_10d"),
        "behavioral_voi": flag("behavioral_voi") | has("behavioral_voi"),
    }
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in layers.items()]))


def role_visible(role: Column, ais_matched: Column, watch: Column, show_matched=True, show_unmatched=True,
                 show_context=True, show_connectors=True, watch_only=False) -> Column:
    """Which radar features a viewer with these toggles sees."""
    matched = F.coalesce(ais_matched, F.lit(False))
    shown = (F.when(role == "historical_ais_context", F.lit(show_matched and show_context))
             .when(role == "sar_ais_connector", F.lit(show_matched and show_connectors))
             .when(matched, F.lit(show_matched)).otherwise(F.lit(show_unmatched)))
    return shown & (F.coalesce(watch, F.lit(False)) if watch_only else F.lit(True))


def valid_imo(value) -> Column:
    text = norm_digits(value)
    return F.when(F.length(text) == 7, text)


def valid_mmsi(value) -> Column:
    text = norm_digits(value)
    return F.when(F.length(text) == 9, text)
