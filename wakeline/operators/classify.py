"""Rule-based vessel classification and the tanker context statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo
from wakeline.functions.records import is_tanker, zone_ids
from wakeline.functions.text import norm_digits, norm_text, parse_float, present, to_bool
from wakeline.functions.times import time_chunk
from wakeline.operators.keyed import chunked_rank, chunked_sum, within
from wakeline.operators.matching import add_port_match, assess_flag, match_watchlist


def _has(name: str, df_columns) -> Column:
    return F.coalesce(F.col(name).cast("boolean"), F.lit(False)) if name in df_columns else F.lit(False)


def hard_flag_reasons(band: Column, status: Column, sanctioned: Column, manual: Column, port_confirmed: Column,
                      area: Column, missing_imo: Column) -> Column:
    """Corroboration reasons in rule order."""
    hard = F.coalesce((band == "hard") | status.isin(*P.HARD_REGISTRY_STATUSES), F.lit(False))
    return F.array_compact(F.array(
        F.when(hard, "hard_flag_registry_status"),
        F.when(sanctioned, "official_or_manual_sanctions_watchlist_match"),
        F.when(manual, "manual_falseflag_watchlist_match"),
        F.when(port_confirmed, "recent_or_current_russian_port_context"),
        F.when(area, "core_or_gateway_area"),
        F.when(missing_imo, "missing_imo_current_ais")))


def is_hard_flag(reasons: Column) -> Column:
    """A manual flag, or a hard registry plus at least one more reason."""
    return (F.array_contains(reasons, "manual_falseflag_watchlist_match")
            | (F.array_contains(reasons, "hard_flag_registry_status") & (F.size(reasons) >= 2)))


def portcall_confidence(confirmed: Column, unconfirmed: Column, declared: Column) -> Column:
    return (F.when(confirmed, "confirmed").when(unconfirmed, "unconfirmed")
            .when(declared, "declared_destination_only"))


def classify(contacts: DataFrame, watch: DataFrame, terms: DataFrame, flags: DataFrame) -> DataFrame:
    """Contacts with categories, match, port, flag and tanker columns. One output row per input row."""
    cols = contacts.columns
    df = match_watchlist(contacts, watch)
    df = add_port_match(df, terms, {"destination": "dest_declared", "last_port": "port_observed"})
    df = assess_flag(df, flags)
    mmsi = norm_digits("mmsi")
    matched = F.col("matched_on").isNotNull()
    track = {n: F.coalesce(to_bool(F.col("watch_track_" + n).cast("string")), F.lit(False))
             for n in ("sanctions", "shadowfleet", "falseflag", "behavior")}
    none = F.expr("CAST(array() AS ARRAY<STRING>)")
    df = df.withColumns({
        "is_tanker": is_tanker("ship_type", "ship_type_text", "destination"),
        "to_russia_declared": _has("to_russia_declared", cols) | F.col("dest_declared"),
        "recent_russian_portcall_unconfirmed_10d": _has("recent_russian_portcall_unconfirmed_10d", cols),
        "from_russia_confirmed": _has("recent_russian_portcall_confirmed_10d", cols) | F.col("port_observed"),
        "sanctioned": track["sanctions"], "shadow_fleet": track["shadowfleet"], "behavioral_voi": track["behavior"],
        "_manual": track["falseflag"],
        "false_flag_candidate": F.coalesce(F.col("flag_risk_band") != "context", F.lit(False)),
        "_area": geo.in_gateway_area(F.col("latitude"), F.col("longitude")),
        "_no_imo": F.coalesce(present("imo").isin("—", "-"), F.lit(True)) & mmsi.isNotNull(),
        "_russian": F.coalesce(mmsi.startswith("273"), F.lit(False)),
    })
    reasons = hard_flag_reasons(F.col("flag_risk_band"), F.col("flag_registry_status"),
                                F.col("sanctioned") | F.col("shadow_fleet"), F.col("_manual"),
                                F.col("from_russia_confirmed"), F.col("_area"), F.col("_no_imo"))
    df = df.withColumns({
        "tanker_zones": F.when(geo.valid_position(F.col("latitude"), F.col("longitude")), zone_ids(
            F.col("latitude"), F.col("longitude"), F.col("is_tanker"))).otherwise(none),
        "recent_ru_portcall_confidence": portcall_confidence(
            F.col("from_russia_confirmed"), F.col("recent_russian_portcall_unconfirmed_10d"),
            F.col("to_russia_declared")),
        "false_flag_hard_reasons": F.when(F.col("flag_risk_band").isNotNull() | matched, reasons).otherwise(none),
        "false_flag": F.col("_manual") | F.col("false_flag_candidate")})
    df = df.withColumn("false_flag_hard_watch", is_hard_flag(F.col("false_flag_hard_reasons")))
    found = F.expr("""array_sort(array_compact(array(
        IF(_russian, 'russian_mmsi', NULL),
        IF(from_russia_confirmed OR recent_russian_portcall_unconfirmed_10d, 'recent_russian_portcall_10d', NULL),
        IF(false_flag, 'falseflag_interest', NULL), IF(false_flag_hard_watch, 'false_flag_watch', NULL),
        IF(matched_on IS NOT NULL, 'watchlist', NULL), IF(sanctioned OR shadow_fleet, 'sanctions_shadowfleet', NULL),
        IF(behavioral_voi, 'behavioral_voi', NULL))))""")
    df = df.withColumn("_found", found).withColumn("neutral_tanker_context", F.expr(
        "size(tanker_zones) > 0 AND size(_found) = 0 AND NOT to_russia_declared"))
    return df.withColumns({
        "categories": F.when(F.col("neutral_tanker_context"), F.array(F.lit("neutral_tanker_context"))).otherwise(
            F.col("_found")),
        "index_impact": F.when(F.col("neutral_tanker_context"), "none_or_soft_context_only").when(
            F.size("_found") > 0, "voi_context").otherwise("none")}).drop("_found", "_manual", "_area", "_no_imo",
                                                                          "_russian")


def category_counts(items: DataFrame) -> DataFrame:
    return items.select(F.explode("categories").alias("category")).groupBy("category").agg(F.count("*").alias("n"))


def snapshot_counters(items: DataFrame) -> DataFrame:
    """One row of conditional counts over a classified snapshot."""
    has = lambda c: F.array_contains("categories", c)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    count = lambda cond, name: F.count_if(cond).alias(name)
    return items.agg(
        F.count("*").alias("total_items"),
        count(flag("from_russia_confirmed"), "from_russia_confirmed"),
        count(flag("to_russia_declared"), "to_russia_declared_database_only"),
        count(flag("recent_russian_portcall_unconfirmed_10d"), "recent_russian_portcall_unconfirmed_10d"),
        count(has("falseflag_interest"), "falseflag_interest"),
        count(has("false_flag_watch"), "false_flag_watch_hard"),
        count(has("recent_russian_portcall_10d"), "recent_russian_portcall_10d"),
        count(has("neutral_tanker_context"), "neutral_tanker_context"),
        count(has("watchlist"), "watchlist"))


def tanker_zone_items(items: DataFrame) -> DataFrame:
    """One row per zone tanker item and zone, with the per-item facts the statistics count."""
    sog = F.coalesce(parse_float("sog"), F.lit(999.0))
    return (items.where("is_tanker").withColumn("zone_id", F.explode("tanker_zones"))
            .withColumn("neutral", F.array_contains("categories", "neutral_tanker_context"))
            .withColumn("slow", sog <= 3.0)
            .withColumn("for_order", F.coalesce(norm_text("destination").rlike(P.FOR_ORDER_PATTERN), F.lit(False))))


def zone_level(neutral: Column, voi: Column, total: Column) -> Column:
    return (F.when((neutral >= 10) & (voi >= 1), "heightened_context")
            .when((neutral >= 10) | (total >= 14), "watch").otherwise("context"))


def tanker_cluster_stats(items: DataFrame) -> DataFrame:
    """Per zone: tankers, neutral and other ones, slow ones, 'for order' ones, and a level."""
    counted = tanker_zone_items(items).groupBy("zone_id").agg(
        F.count("*").alias("total_tankers"), F.count_if("neutral").alias("neutral_tankers"),
        F.count_if(~F.col("neutral")).alias("voi_tankers"), F.count_if("slow").alias("slow_or_waiting"),
        F.count_if("for_order").alias("for_order"))
    return counted.withColumn("level", zone_level(F.col("neutral_tankers"), F.col("voi_tankers"),
                                                  F.col("total_tankers")))


def zone_entity_counts(items: DataFrame, key: str) -> DataFrame:
    """Distinct tankers, neutral and other ones over all zones."""
    zoned = items.where("is_tanker AND size(tanker_zones) > 0").withColumn(
        "neutral", F.array_contains("categories", "neutral_tanker_context"))
    per_key = zoned.groupBy(key).agg(F.bool_or("neutral").alias("n"), F.bool_or(~F.col("neutral")).alias("v"))
    return per_key.agg(F.count("*").alias("unique_tankers"), F.count_if("n").alias("neutral_tankers"),
                       F.count_if("v").alias("voi_tankers"))


def zone_examples(items: DataFrame, order: str, n: int | None = None) -> DataFrame:
    """Items of every zone as rows with ``example_rank``, and whether they are within the optional limit."""
    chunk = F.floor(F.col(order) / 65536)
    ranked = chunked_rank(tanker_zone_items(items), ["zone_id"], chunk, [F.col(order)], "example_rank")
    return ranked.withColumn("within_limit", within("example_rank", n)).select(
        "zone_id", "example_rank", "within_limit", order, "name", "imo", "mmsi", "destination", "sog", "categories")


def cap_neutral(items: DataFrame, seq: str = "row_id", newest_first: bool = False, cap: P.TankerCap = P.TankerCap(),
                chunk_seconds: int = 86400) -> DataFrame:
    """Neutral items with their best rank in a zone, their rank overall, and whether both are within the optional cap.

    Waiting ones come first. Being skipped only when all zones are full is the same as having a rank within the
    limit in some zone. Ranks run over chunks of time, so neither a zone nor the whole is one task.
    """
    neutral = items.where(F.array_contains("categories", "neutral_tanker_context")).withColumn(
        "_moving", F.coalesce(parse_float("sog"), F.lit(999.0)) > cap.slow_knots)
    at = F.col("last_seen").desc_nulls_last() if newest_first else F.col("last_seen").asc_nulls_last()
    order = [F.col("_moving"), at, F.col(seq)]
    step = time_chunk(F.col("last_seen"), chunk_seconds)
    chunk = F.struct(F.col("_moving").alias("m"), F.coalesce(-step if newest_first else step, F.lit(2 ** 62)).alias("t"))
    zoned = chunked_rank(neutral.withColumn("_zone", F.explode("tanker_zones")), ["_zone"], chunk, order, "_n")
    best = zoned.groupBy(seq).agg(F.min("_n").alias("zone_rank"))
    ranked = neutral.join(best, seq).withColumn("_in_zone", within("zone_rank", cap.per_zone))
    counted = chunked_sum(ranked, [], chunk, order, F.col("_in_zone").cast("bigint"), "total_rank")
    return counted.withColumn("within_limit", F.col("_in_zone") & within("total_rank", cap.total)).drop("_moving", "_in_zone")
