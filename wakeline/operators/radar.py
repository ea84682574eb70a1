"""Tracks projected to a radar scene's time and matched with its detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo
from wakeline.functions.records import short_sha1
from wakeline.functions.tables import fixed_table
from wakeline.functions.times import time_chunk
from wakeline.operators.keyed import chunked_rank, top_k, within
from wakeline.operators.snapshot import nearest_times
from wakeline.session import stored


# --- coverage ------------------------------------------------------------------------

def coverage_bins(messages: DataFrame, window_start: Column, total_bins: int, at: str, params: P.MatchParams
                  ) -> DataFrame:
    """Distinct messages per time bin, zero bins included; the last bin takes its right edge."""
    distinct = messages.select("mmsi", at, "latitude", "longitude").distinct()
    width = params.bin_minutes * 60
    number = F.least(F.lit(total_bins - 1), F.floor(
        (F.unix_seconds(at) - F.unix_seconds(window_start)) / width)).cast("int")
    counted = distinct.groupBy(number.alias("bin")).agg(F.count("*").alias("messages"))
    bins = messages.sparkSession.range(total_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counted, "bin", "left").select("bin", F.coalesce("messages", F.lit(0)).alias("messages"))


def coverage_summary(messages: DataFrame, window_start: Column, total_bins: int, at: str, params: P.MatchParams
                     ) -> DataFrame:
    """One row: distinct messages, vessels, occupied bins and whether that suffices for a comparison."""
    distinct = messages.select("mmsi", at, "latitude", "longitude").distinct()
    number = F.least(F.lit(total_bins - 1), F.floor(
        (F.unix_seconds(at) - F.unix_seconds(window_start)) / (params.bin_minutes * 60)))
    per_vessel_bin = distinct.groupBy("mmsi", number.alias("bin")).agg(F.count("*").alias("n"))
    out = per_vessel_bin.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("distinct_messages"),
                             F.count_distinct("mmsi").alias("distinct_mmsi"),
                             F.count_distinct("bin").alias("occupied_bins"))
    enough = ((F.col("distinct_messages") >= params.minimum_messages)
              & (F.col("distinct_mmsi") >= params.minimum_mmsi) & (F.col("occupied_bins") >= params.minimum_bins))
    return out.withColumn("total_bins", F.lit(total_bins)).withColumn("sufficient", enough).withColumn(
        "status", F.when(enough, "AVAILABLE_AIS_ACTIVITY_OBSERVED").otherwise("NO_AIS_COVERAGE"))


# --- projection ----------------------------------------------------------------------

def gap_quality(gap: Column, bracketed: bool, params: P.MatchParams) -> Column:
    medium = F.when(gap <= params.medium_gap_seconds, "MEDIUM").otherwise("LOW")
    return F.when(gap <= params.high_gap_seconds, "HIGH").otherwise(medium) if bracketed else medium


def project_tracks(bracketed: DataFrame, scene_at: Column, key: str = "mmsi", at: str = "observed_at",
                   params: P.MatchParams = P.MatchParams()) -> DataFrame:
    """Position of each vessel at the scene time.

    Input: ``snapshot.bracketing`` rows. Ladder: exact observation, linear interpolation between
    the two neighbours, dead reckoning from one side, nearest position without motion.
    """
    obs = F.struct(F.unix_seconds(at).alias("t"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"),
                   F.col("sog").cast("double").alias("sog"), F.col("cog").cast("double").alias("cog"))
    pick = lambda side: F.max(F.when((F.col("side") == side) & (F.col("rank") == 1), obs))
    both = bracketed.groupBy(key).agg(pick("before").alias("b"), pick("after").alias("a"),
                                      F.count("*").alias("retained_observations"))
    t = F.unix_seconds(scene_at)
    has_b, has_a = F.col("b").isNotNull(), F.col("a").isNotNull()
    exact = has_b & (F.col("b.t") == t)
    linear = has_b & has_a
    span = F.nullif(F.col("a.t") - F.col("b.t"), F.lit(0))
    factor = (t - F.col("b.t")) / span
    lin_lon = F.col("b.lon") + factor * (F.col("a.lon") - F.col("b.lon"))
    lin_lat = F.col("b.lat") + factor * (F.col("a.lat") - F.col("b.lat"))
    length = geo.haversine_m(F.col("b.lon"), F.col("b.lat"), F.col("a.lon"), F.col("a.lat"))
    lin_sog = length / 1852.0 / (span / 3600.0)
    lin_cog = geo.bearing(F.col("b.lon"), F.col("b.lat"), F.col("a.lon"), F.col("a.lat"))
    lin_gap = F.least(t - F.col("b.t"), F.col("a.t") - t)
    lin_motion = F.least(length * factor, length * (1.0 - factor))
    one = F.coalesce("b", "a")
    df = both.withColumn("n", one)
    delta = t - F.col("n.t")
    motion_ok = F.coalesce(F.col("n.sog").between(0, params.maximum_sog_knots) & (F.col("n.cog") >= 0)
                           & (F.col("n.cog") < 360), F.lit(False))
    signed = F.col("n.sog") * 1852.0 * (delta / 3600.0)
    dr_lon, dr_lat = geo.destination(F.col("n.lon"), F.col("n.lat"), F.col("n.cog"), signed)

    def ladder(on_exact, on_linear, on_reckon, on_nearest) -> Column:
        return (F.when(exact, on_exact).when(linear, on_linear).when(motion_ok, on_reckon).otherwise(on_nearest))

    none = F.lit(None).cast("double")
    too_fast = lin_sog > params.maximum_sog_knots
    return df.select(
        key,
        F.round(ladder(F.col("b.lon"), lin_lon, dr_lon, F.col("n.lon")), 7).alias("projected_longitude"),
        F.round(ladder(F.col("b.lat"), lin_lat, dr_lat, F.col("n.lat")), 7).alias("projected_latitude"),
        ladder(F.lit("EXACT_ARCHIVE_OBSERVATION"), F.lit("LINEAR_INTERPOLATION_BRACKETED"),
               F.lit("SOG_COG_EXTRAPOLATION_SINGLE_SIDED"), F.lit("NEAREST_OBSERVATION_NO_MOTION_MODEL")
               ).alias("projection_method"),
        ladder(F.lit("HIGH"), F.when(too_fast, "LOW").otherwise(gap_quality(lin_gap, True, params)),
               gap_quality(F.abs(delta), False, params), F.lit("LOW")).alias("projection_quality"),
        ladder(F.lit(0).cast("bigint"), lin_gap, F.abs(delta), F.abs(delta)).alias("nearest_gap_seconds"),
        F.when(~exact & linear, span).alias("bracket_span_seconds"),
        F.round(ladder(F.lit(0.0), lin_motion, F.abs(signed), F.lit(0.0)), 2).alias("motion_distance_m"),
        F.round(ladder(F.col("b.sog"), lin_sog, F.col("n.sog"), F.coalesce("n.sog", none)), 2).alias("effective_sog"),
        F.round(ladder(F.col("b.cog"), lin_cog, F.col("n.cog"), F.coalesce("n.cog", none)), 2).alias("effective_cog"),
        "retained_observations",
    )


def local_context(projected: DataFrame, west: Column, south: Column, east: Column, north: Column, pad_nm: float
                  ) -> DataFrame:
    box = geo.expand_bbox(west, south, east, north, F.lit(pad_nm))
    return projected.where(geo.in_box(F.col("projected_longitude"), F.col("projected_latitude"), *box))


# --- matching ------------------------------------------------------------------------

def dynamic_radius(method: Column, motion_m: Column, span_x: Column, span_y: Column, params: P.MatchParams) -> Column:
    """Search radius in metres from motion, method and signature size."""
    movement = F.least(F.lit(params.movement_cap_m), motion_m * params.movement_fraction)
    penalty = (F.when(method == "SOG_COG_EXTRAPOLATION_SINGLE_SIDED", params.single_sided_penalty_m)
               .when(method == "NEAREST_OBSERVATION_NO_MOTION_MODEL", params.no_motion_penalty_m).otherwise(0.0))
    x = F.greatest(F.lit(0.0), F.coalesce(span_x, F.lit(0.0)))
    y = F.greatest(F.lit(0.0), F.coalesce(span_y, F.lit(0.0)))
    extent = F.least(F.lit(params.extent_cap_m), F.sqrt(x * x + y * y) / 2.0)
    total = params.minimum_radius_m + movement + penalty + extent
    return F.least(F.lit(params.maximum_distance_m), F.greatest(F.lit(params.minimum_radius_m), total))


def _detection_cells(detections: DataFrame, distance_m: float, size: float) -> DataFrame:
    pad_lat = distance_m / 1852.0 / 60.0 * 1.01
    pad_lon = pad_lat / F.greatest(F.lit(0.02), F.cos(F.radians(F.abs(F.col("latitude")) + pad_lat)))
    return (detections
            .withColumn("cy", F.explode(F.sequence(geo.cell(F.col("latitude") - pad_lat, size),
                                                   geo.cell(F.col("latitude") + pad_lat, size))))
            .withColumn("cx", F.explode(F.sequence(geo.cell(F.col("longitude") - pad_lon, size),
                                                   geo.cell(F.col("longitude") + pad_lon, size)))))


def candidate_pairs(detections: DataFrame, projected: DataFrame, params: P.MatchParams = P.MatchParams(),
                    detection: str = "detection_id", vessel: str = "mmsi") -> DataFrame:
    """All (detection, vessel) pairs within the hard limit, with the dynamic radius test.

    Detections: id, longitude, latitude, span_x_m, span_y_m. The join key is a cell a little
    larger than the limit, so only neighbours meet. Detections are listed in several cells, which no file size tells,
    so that side must not be taken for a small one: the join is a sorted one.
    """
    d = _detection_cells(detections, params.maximum_distance_m, params.cell_degrees)
    v = projected.withColumn("cx", geo.cell(F.col("projected_longitude"), params.cell_degrees)).withColumn(
        "cy", geo.cell(F.col("projected_latitude"), params.cell_degrees))
    raw = geo.haversine_m(F.col("longitude"), F.col("latitude"), F.col("projected_longitude"),
                          F.col("projected_latitude"))
    radius = dynamic_radius(F.col("projection_method"), F.col("motion_distance_m"), F.col("span_x_m"),
                            F.col("span_y_m"), params)
    return (d.join(v.hint("merge"), ["cx", "cy"]).withColumn("_d", raw).where(F.col("_d") <= params.maximum_distance_m)
            .withColumn("distance_m", F.round("_d", 1)).withColumn("dynamic_radius_m", F.round(radius, 2))
            .withColumn("within_dynamic_radius", F.col("_d") <= radius).drop("_d", "cx", "cy"))


def competition(pairs: DataFrame, detection: str = "detection_id", vessel: str = "mmsi") -> DataFrame:
    """Pairs with the number of vessels per detection and of detections per vessel (grouped counts, joined back)."""
    per_detection = pairs.groupBy(detection).agg(F.count("*").alias("vessels"))
    per_vessel = pairs.groupBy(vessel).agg(F.count_distinct(detection).alias("detections"))
    return pairs.join(per_detection, detection).join(per_vessel, vessel)


def match_states(detections: DataFrame, pairs: DataFrame, sufficient: DataFrame, detection: str = "detection_id",
                 vessel: str = "mmsi") -> DataFrame:
    """One row per detection with its state and the selected vessel. ``sufficient``: one row, one boolean."""
    counted = competition(pairs, detection, vessel)
    per = counted.groupBy(detection).agg(
        F.max("vessels").alias("alternatives"), F.max("detections").alias("rivals"),
        F.min(F.struct("distance_m", vessel, "within_dynamic_radius", "projection_quality")).alias("best"))
    df = detections.select(detection).join(per, detection, "left").withColumn(
        "sufficient", sufficient.select("sufficient").scalar())
    n = F.coalesce("alternatives", F.lit(0))
    good = F.col("sufficient") & F.col("best.within_dynamic_radius") & F.col("best.projection_quality").isin(
        "HIGH", "MEDIUM")
    state = (F.when((n == 0) & F.col("sufficient"), "UNMATCHED_IN_AVAILABLE_AIS").when(n == 0, "NO_AIS_COVERAGE")
             .when((n > 1) | (F.col("rivals") > 1), "AMBIGUOUS").when(good, "MATCHED").otherwise("POSSIBLE_MATCH"))
    reason = (F.when(n > 1, "MULTIPLE_PLAUSIBLE_AIS_VESSELS_FOR_ONE_SAR_CANDIDATE")
              .when(F.col("rivals") > 1, "ONE_AIS_VESSEL_PLAUSIBLE_FOR_MULTIPLE_SAR_CANDIDATES"))
    out = df.withColumn("match_state", state).withColumn("ambiguity_reason", reason)
    chosen = F.col("match_state").isin("MATCHED", "POSSIBLE_MATCH")
    return out.select(detection, "match_state", "ambiguity_reason", n.alias("alternatives"),
                      F.when(chosen, F.col("best")[vessel]).alias("selected_mmsi"),
                      F.when(chosen, F.col("best.distance_m")).alias("selected_distance_m"))


def evidence(pairs: DataFrame, params: P.MatchParams = P.MatchParams(), detection: str = "detection_id",
             vessel: str = "mmsi") -> DataFrame:
    """Every alternative of a detection with its rank by distance, and whether it is within the optional limit."""
    totals = pairs.groupBy(detection).agg(F.count("*").alias("alternatives"))
    ranked = top_k(pairs, [detection], [F.col("distance_m"), F.col(vessel)], None, rank="evidence_rank")
    return ranked.join(totals, detection).withColumn("within_limit", within("evidence_rank", params.evidence_limit))


def label_counts(df: DataFrame, column: str, labels) -> DataFrame:
    """Histogram over a fixed label list, zeros included."""
    domain = fixed_table(df.sparkSession, ("label",), [(x,) for x in labels])
    counted = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    return domain.join(counted, "label", "left").select("label", F.coalesce("n", F.lit(0)).alias("n"))


# --- gridded radar and presence ------------------------------------------------------

GRID_KEY = ("region_id", "ais_matched", "observed_at", "lat5", "lon5", "vessel_id", "imo", "mmsi")


#: A vessel with more rows than one task should order goes by chunks of this length.
BUSY_ROWS, BUSY_CHUNK_SECONDS = 1_000_000, 30 * 86400
#: The chunk of a busy vessel's row, and the number that rows are dealt by.
PART, DEAL = "_part", "_deal"


def in_chunks(rows: DataFrame, vessel: str = "vessel_id", at: str = "observed_at", more_than: int = BUSY_ROWS) -> DataFrame:
    """The rows with the time chunk of those of busy vessels, NULL for others; without a column if no vessel is busy."""
    counts = rows.where(F.col(vessel).isNotNull()).groupBy(vessel).agg(F.count("*").alias("_n"))
    busy = stored(counts.where(F.col("_n") > more_than).select(vessel))
    if busy.isEmpty():
        return rows
    marked = rows.join(busy.withColumn("_busy", F.lit(True)), vessel, "left")
    return marked.withColumn(PART, F.when(F.col("_busy"), time_chunk(F.col(at), BUSY_CHUNK_SECONDS))).drop("_busy")


def _part(columns) -> list[str]:
    return [PART] if PART in columns else []


def _deal(vessel: str, columns, spread: Column | None = None) -> Column:
    """The number a vessel's rows are dealt by, another one for each chunk; rows without a vessel go by ``spread``."""
    key = F.col(vessel) if spread is None else F.coalesce(F.col(vessel), spread)
    return F.pmod(F.xxhash64(key, *_part(columns)), F.lit(2 ** 16)).cast("int")


def valid_grid(rows: DataFrame) -> DataFrame:
    return rows.where(geo.valid_position(F.col("latitude"), F.col("longitude")) & F.col("observed_at").isNotNull())


def grid_records(rows: DataFrame, prefix: str, key=GRID_KEY, together: str | None = None) -> DataFrame:
    """Valid gridded rows, one per key, with a hashed id.

    With ``together``, a vessel column of the key, the rows are dealt out by vessel (and chunk) before they are
    compared, and keep their number, so that ``correlate`` finds them in place and they are shuffled once.
    """
    keyed, places = valid_grid(rows), {"lat5": F.round("latitude", 5), "lon5": F.round("longitude", 5)}
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]
    if together:  # rounded behind the shuffle
        spread = F.xxhash64(*[places.get(k, F.col(k)) for k in key]).cast("string")
        keyed = keyed.withColumn(DEAL, _deal(together, keyed.columns, spread)).repartition(DEAL)
        key = (DEAL, *_part(keyed.columns), *key)
    return keyed.withColumns(places).dropDuplicates(list(key)).withColumn("id", short_sha1(prefix, *parts))


def grid_dedup_counts(rows: DataFrame, key=GRID_KEY) -> DataFrame:
    """Rows seen, invalid and duplicate, in one grouped pass."""
    ok = geo.valid_position(F.col("latitude"), F.col("longitude")) & F.col("observed_at").isNotNull()
    marked = rows.withColumn("ok", ok).withColumn("lat5", F.round("latitude", 5)).withColumn(
        "lon5", F.round("longitude", 5))
    per_key = marked.groupBy("ok", *key).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("rows_seen"),
                       F.sum(F.when(~F.col("ok"), F.col("n")).otherwise(0)).alias("rows_invalid"),
                       F.sum(F.when(F.col("ok"), F.col("n") - 1).otherwise(0)).alias("duplicates"))


def select_context_ids(records: DataFrame, limit: int | None = None, vessel: str = "vessel_id") -> DataFrame:
    """All vessels with matched records. With a limit: watchlist vessels always, others fill the rest, newest first."""
    per = (records.where(F.col("ais_matched") & F.col(vessel).isNotNull()).groupBy(vessel)
           .agg(F.max(F.struct("observed_at", "watchlist_match")).alias("_latest"))
           .select(vessel, F.col("_latest.observed_at").alias("newest"),
                   F.col("_latest.watchlist_match").alias("protected")))
    if limit is None:
        return per
    protected = per.where("protected")
    room = protected.agg(F.greatest(F.lit(0), F.lit(limit) - F.count("*")).alias("room"))
    # At most ``limit`` unprotected ids can be kept, so they are cut down before being numbered.
    others = per.where("NOT protected").orderBy(F.col("newest").desc(), F.col(vessel)).limit(limit)
    numbered = top_k(others, [F.lit(0)], [F.col("newest").desc(), F.col(vessel)], limit, rank="n")
    kept = numbered.where(F.col("n") <= room.scalar()).drop("n")
    return protected.unionByName(kept)


def _closest(at: Column, before: Column, after: Column, lon: Column, lat: Column, limit_minutes: float) -> Column:
    """The presence row closest in time, then in distance, of the lists at the times before and after, within the limit."""
    delta = lambda side: F.abs(F.unix_micros(side["at"]) - F.unix_micros(at)) / 60e6
    never = F.lit(float("inf"))
    nearest = F.least(F.coalesce(delta(before), never), F.coalesce(delta(after), never))

    def found(side: Column) -> Column:
        row = lambda r: F.struct(
            nearest.alias("_delta"), F.round(geo.haversine_nm(lon, lat, r["longitude"], r["latitude"]), 6).alias("_dist"),
            r["id"].alias("ais_id"), side["at"].alias("_t"), r["latitude"].alias("ais_lat"), r["longitude"].alias("ais_lon"))
        return F.when(delta(side) == nearest, F.array_min(F.transform(side["rows"], row)))

    return F.when(nearest <= limit_minutes, F.least(found(before), found(after)))


def correlate(sar: DataFrame, ais: DataFrame, selected: DataFrame, limit_minutes: float, vessel: str = "vessel_id"
              ) -> DataFrame:
    """Each radar record with its status and the closest-in-time presence row of the same vessel.

    The vessel's rows in the same region are used when there are any, else those of all regions.
    Records, presence rows and the selected vessels are one frame dealt by vessel: two ordered passes, by region and over
    all regions, carry the presence rows at the nearest times, and the records never move by id. Records that ask for
    nothing take no part. Sides that ``grid_records`` has dealt ``together`` are not shuffled again.
    """
    part = _part(sar.columns)
    place = [DEAL, *part]
    sar, ais = [side if DEAL in side.columns else side.withColumn(DEAL, _deal(vessel, side.columns)) for side in (sar, ais)]
    asks = F.coalesce(F.col("ais_matched") & F.col(vessel).isNotNull(), F.lit(False))
    asked = sar.where(asks).withColumns({"_at": F.col("observed_at"), "_side": F.lit(1)})
    context = ais.where(F.col(vessel).isNotNull() & F.col("observed_at").isNotNull()).groupBy(
        *place, vessel, "region_id", F.col("observed_at").alias("_at")).agg(
        F.collect_list(F.struct("id", "latitude", "longitude")).alias("_rows")).withColumn("_side", F.lit(0))
    chosen = selected.select(vessel).where(F.col(vessel).isNotNull())
    if part:  # each chunk of a busy vessel is told that it is selected
        chosen = chosen.join(stored(asked.where(F.col(PART).isNotNull()).select(vessel, PART).distinct()), vessel, "left")
    chosen = chosen.withColumn(DEAL, _deal(vessel, chosen.columns)).repartition(DEAL).withColumn("_side", F.lit(2))
    both = asked.unionByName(context, allowMissingColumns=True).unionByName(chosen, allowMissingColumns=True)
    chunk = F.col(PART) if part else None
    pick = _closest(F.col("_at"), F.col("_before"), F.col("_after"), F.col("longitude"), F.col("latitude"), limit_minutes)
    mine = F.col("_side") == 1
    here = mine & F.col("region_id").isNotNull() & (F.col("_before").isNotNull() | F.col("_after").isNotNull())
    near = nearest_times(both, [vessel, "region_id"], "_at", "_side", "_rows", "_before", "_after", chunk, [DEAL], single=True)
    near = near.withColumns({"_here": here, "_best": F.when(here, pick)}).drop("_before", "_after")
    vessels = Window.partitionBy(DEAL, vessel, *part).orderBy("_at", "_side").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    near = nearest_times(near, [vessel], "_at", "_side", "_rows", "_before", "_after", chunk, [DEAL]).withColumn(
        "_sel", F.max(F.col("_side") == 2).over(vessels))
    near = near.where(mine).withColumn("_best", F.when(F.col("_sel"), F.when(F.col("_here"), F.col("_best")).otherwise(pick)))
    columns = ["id", *[c for c in sar.columns if c not in ("id", *place)]]
    out = near.select(*columns, "_sel", "_best").unionByName(
        sar.where(~asks).select(*columns, F.lit(False).alias("_sel")), allowMissingColumns=True)
    status = (F.when(~F.col("ais_matched"), "not_applicable_ais_unmatched")
              .when(~F.col("_sel"), "not_requested_identity_cap")
              .when(F.col("_best").isNotNull(), "time_aligned_same_identity")
              .otherwise("requested_but_no_time_aligned_context"))
    return (out.withColumn("correlation_status", status).withColumn("ais_context_id", F.col("_best.ais_id"))
            .withColumn("ais_observed_at", F.col("_best._t"))
            .withColumn("ais_latitude", F.col("_best.ais_lat")).withColumn("ais_longitude", F.col("_best.ais_lon"))
            .withColumn("time_delta_minutes", F.round("_best._delta", 1))
            .withColumn("distance_nm", F.round("_best._dist", 2)).drop("_best", "_sel"))


CORRELATION_STATUSES = ("not_applicable_ais_unmatched", "not_requested_identity_cap", "time_aligned_same_identity",
                        "requested_but_no_time_aligned_context")


def correlation_summary(correlated: DataFrame) -> DataFrame:
    is_ = lambda s: F.col("correlation_status") == s
    return correlated.agg(
        F.count("*").alias("sar_records"),
        F.count_if(is_("not_applicable_ais_unmatched")).alias("ais_unmatched_sar"),
        F.count_if(is_("not_requested_identity_cap")).alias("matched_identity_not_selected"),
        F.count_if(is_("time_aligned_same_identity") | is_("requested_but_no_time_aligned_context")
                   ).alias("matched_identity_selected"),
        F.count_if(is_("time_aligned_same_identity")).alias("time_aligned_correlations"),
        F.count_if(is_("requested_but_no_time_aligned_context")).alias("selected_without_time_aligned_context"))


def prioritised(records: DataFrame, cap: int | None = None, chunk_seconds: int = 86400) -> DataFrame:
    """Every record with its place in ``radar_order`` and whether it is within the optional cap."""
    newest = F.coalesce(-time_chunk(F.col("observed_at"), chunk_seconds), F.lit(2 ** 62))
    chunk = F.struct((~F.col("watchlist_match")).alias("w"), F.col("ais_matched").alias("a"), newest.alias("t"))
    ranked = chunked_rank(records, [], chunk, radar_order(), "priority_rank")
    return ranked.withColumn("within_limit", within("priority_rank", cap))


def radar_order() -> list[Column]:
    return [F.col("watchlist_match").desc(), F.col("ais_matched").asc(), F.col("observed_at").desc(), F.col("id").asc()]
