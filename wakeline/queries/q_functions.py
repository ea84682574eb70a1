"""Scalar column functions."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo, identity, records, text, times
from wakeline.operators import reference
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import AS_OF
from wakeline.queries.registry import query
from wakeline.sources import feeds


@query("fn01_norm_text", f"SELECT event_id, {S.norm_text('name')} AS out FROM v_contacts")
def _(t):
    return t.contacts.select("event_id", text.norm_text("name").alias("out"))


@query("fn02_norm_key", f"SELECT doc_id, {S.norm_key("replace(text, 'ß', 'ss')")} AS out FROM documents")
def _(t):
    return t.table("documents").select("doc_id", text.norm_key("text").alias("out"))


@query("fn03_norm_digits", f"SELECT page_id, {S.digits('html')} AS out FROM pages")
def _(t):
    return t.table("pages").select("page_id", text.norm_digits("html").alias("out"))


@query("fn04_split_tokens", """
SELECT line_no, unnest([trim(x) FOR x IN string_split_regex(mmsi_mid_prefixes, '[;,|]') IF trim(x) <> '']) AS token FROM v_flags""")
def _(t):
    return t.flags.select("line_no", F.explode(text.split_tokens("mmsi_mid_prefixes")).alias("token"))


@query("fn05_to_bool", """
SELECT line_no, coalesce(lower(trim(active)) IN ('1', 'true', 'yes', 'y', 'on'), false) AS active,
 coalesce(lower(trim(CAST(track_sanctions AS VARCHAR))) IN ('1', 'true', 'yes', 'y', 'on'), false) AS sanctioned
FROM v_watchlist""")
def _(t):
    return t.watchlist.select("line_no", text.to_bool("active").alias("active"),
                              text.to_bool(F.col("track_sanctions").cast("string")).alias("sanctioned"))


_RAW_TIME = """CASE event_id % 7 WHEN 0 THEN CAST(observed_at AS VARCHAR) || ' +0000 UTC' WHEN 1 THEN
 replace(CAST(observed_at AS VARCHAR), ' ', 'T') || '123Z' WHEN 2 THEN 'not a time' WHEN 3 THEN ''
 WHEN 4 THEN substr(CAST(observed_at AS VARCHAR), 1, 10) WHEN 5 THEN substr(CAST(observed_at AS VARCHAR), 1, 19) || '+02:00'
 ELSE substr(CAST(observed_at AS VARCHAR), 1, 19) END"""


def _raw_time(t):
    full = F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    second = F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_id") % 7
    return t.contacts.withColumn("raw", F.when(kind == 0, F.concat(full, F.lit(" +0000 UTC"))).when(
        kind == 1, F.concat(F.replace(full, F.lit(" "), F.lit("T")), F.lit("123Z"))).when(
        kind == 2, "not a time").when(kind == 3, "").when(kind == 4, F.date_format("observed_at", "yyyy-MM-dd")).when(
        kind == 5, F.concat(second, F.lit("+02:00"))).otherwise(second))


@query("fn06_parse_dt", """
SELECT event_id, CASE event_id % 7 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN epoch_us(date_trunc('day', observed_at))
 WHEN 5 THEN epoch_us(date_trunc('second', observed_at)) - 7200000000 WHEN 6 THEN
 epoch_us(date_trunc('second', observed_at)) ELSE epoch_us(observed_at) END AS us FROM v_contacts""")
def _(t):
    return _raw_time(t).select("event_id", F.unix_micros(times.parse_dt("raw")).alias("us"))


@query("fn07_normalize_timestamp", f"""
WITH x AS (SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL WHEN event_id % 11 = 0 THEN TIMESTAMP '1970-01-20 00:00:00'
 ELSE date_trunc('second', observed_at) END AS good FROM v_contacts),
y AS (SELECT event_id, CASE WHEN good BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY THEN good END
 AS g FROM x)
SELECT event_id, epoch(coalesce(g, TIMESTAMP '{AS_OF}'))::BIGINT AS sec, g IS NOT NULL AS valid,
 CASE WHEN g IS NOT NULL THEN 'source_timestamp' ELSE 'retrieval_time_fallback' END AS basis FROM y""")
def _(t):
    at = F.when(F.col("event_id") % 11 == 0, F.lit("1970-01-20 00:00:00").cast("timestamp")).otherwise(
        F.date_trunc("second", "observed_at"))
    kind = F.col("event_id") % 5
    raw = (F.when(kind == 0, F.unix_seconds(at).cast("string")).when(kind == 1, F.unix_millis(at).cast("string"))
           .when((kind == 4), "junk").otherwise(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    # Milliseconds of early 1970 are below the split and would be read as seconds; they are text here.
    raw = F.when((F.col("event_id") % 11 == 0) & (kind < 2), F.unix_seconds(at).cast("string")).otherwise(raw)
    rows = t.contacts.withColumn("raw", raw)
    stamp, valid, basis = times.normalize_timestamp("raw", t.as_of, t.as_of)
    return rows.select("event_id", F.unix_seconds(stamp).alias("sec"), valid.alias("valid"), basis.alias("basis"))


@query("fn08_fallback_history_dt", f"""
SELECT event_id, CASE WHEN seen_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY THEN
 epoch(date_trunc('second', seen_at))::BIGINT WHEN event_id % 2 = 0 THEN epoch(TIMESTAMP '2024-01-20 05:00:00')::BIGINT
 ELSE epoch(TIMESTAMP '{AS_OF}')::BIGINT END AS sec,
CASE WHEN seen_at BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '{AS_OF}' + INTERVAL 1 DAY THEN
 CASE WHEN event_id % 3 = 0 THEN 'retrieval_time_fallback' ELSE 'source_timestamp' END
 WHEN event_id % 2 = 0 THEN 'history_slot_fallback' ELSE 'snapshot_generated_at_fallback' END AS basis FROM v_history""")
def _(t):
    rows = t.history.withColumn("seen", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss")).withColumn(
        "ok", F.col("event_id") % 3 != 0).withColumn("none", F.lit("")).withColumn("key", F.when(
            F.col("event_id") % 2 == 0, F.concat(F.lit("2024-01-20T05:00:00Z|"), "history_key")).otherwise("plain"))
    at, basis = times.fallback_history_dt("seen", "ok", "none", "key", t.as_of, t.as_of)
    return rows.select("event_id", F.unix_seconds(at).alias("sec"), basis.alias("basis"))


@query("fn09_history_dt", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch(date_trunc('second', observed_at))::BIGINT WHEN 1 THEN
 epoch(date_trunc('day', observed_at))::BIGINT WHEN 2 THEN epoch(date_trunc('hour', observed_at))::BIGINT END AS sec
FROM v_contacts""")
def _(t):
    kind = F.col("event_id") % 4
    rows = t.contacts.select(
        "event_id", F.when(kind == 0, F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss")).otherwise("bad").alias("seen"),
        F.when(kind == 1, F.date_format("observed_at", "yyyy-MM-dd")).alias("port"), F.lit("").alias("none"),
        F.when(kind == 2, F.date_format("observed_at", "yyyy-MM-dd'T'HH:00:00'Z|x'")).otherwise("nokey").alias("key"))
    at = times.history_dt("seen", "none", "port", "none", "none", "key")
    return rows.select("event_id", F.unix_seconds(at).alias("sec"))


@query("fn10_current_slot", """
SELECT event_id, strftime(observed_at, '%Y-%m-%dT') || CASE WHEN hour(observed_at) >= 20 THEN '20' WHEN
 hour(observed_at) >= 11 THEN '11' WHEN hour(observed_at) >= 5 THEN '05' ELSE '00' END || ':00:00Z' AS slot
FROM v_contacts""")
def _(t):
    return t.contacts.select("event_id", times.slot_label(F.col("observed_at")).alias("slot"))


@query("fn11_parse_float", """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN 1e100 WHEN 4 THEN NULL ELSE value END AS num
FROM v_contacts""")
def _(t):
    kind = F.col("event_id") % 7
    raw = F.when(kind == 0, "NaN").when(kind == 1, "Infinity").when(kind == 2, "12 kn").when(
        kind == 3, "1e100").when(kind == 4, "1e400").otherwise(F.col("value").cast("string"))
    return t.contacts.select("event_id", text.parse_float(raw).alias("num"))


@query("fn12_sentinel_clean", """
SELECT event_id, CASE WHEN CAST(sog AS DOUBLE) < 102.2 THEN round(CAST(sog AS DOUBLE), 2) END AS sog,
 CASE WHEN CAST(cog AS DOUBLE) < 360 THEN round(CAST(cog AS DOUBLE), 2) END AS cog,
 CASE WHEN CAST(heading AS DOUBLE) < 511 THEN CAST(heading AS INTEGER) END AS heading,
 CAST(sog AS DOUBLE) >= 102.2 AS sog_bad, CAST(cog AS DOUBLE) >= 360 AS cog_bad,
 CAST(heading AS DOUBLE) >= 511 AS heading_bad FROM v_archive""")
def _(t):
    return t.archive.select(
        "event_id", records.clean_motion("sog", "sog").alias("sog"), records.clean_motion("cog", "cog").alias("cog"),
        records.clean_motion("heading", "heading").alias("heading"), records.is_sentinel("sog", "sog").alias("sog_bad"),
        records.is_sentinel("cog", "cog").alias("cog_bad"), records.is_sentinel("heading", "heading").alias("heading_bad"))


@query("fn13_normalize_unknown", f"""
SELECT event_id, CASE WHEN upper({S.present('imo')}) NOT IN ({S.quoted(P.UNKNOWN_WORDS)}) THEN {S.present('imo')} END AS imo,
 CASE WHEN upper({S.present('destination')}) NOT IN ({S.quoted(P.UNKNOWN_WORDS)}) THEN {S.present('destination')} END AS destination
FROM v_archive""")
def _(t):
    return t.archive.select("event_id", text.normalize_unknown("imo").alias("imo"),
                            text.normalize_unknown("destination").alias("destination"))


@query("fn14_valid_position", """
SELECT event_id, CAST(latitude AS DOUBLE) BETWEEN -90 AND 90 AND CAST(longitude AS DOUBLE) BETWEEN -180 AND 180 AS plain,
 NOT (abs(CAST(latitude AS DOUBLE)) < 1e-12 AND abs(CAST(longitude AS DOUBLE)) < 1e-12) AS strict FROM v_archive""")
def _(t):
    lat, lon = text.parse_float("latitude"), text.parse_float("longitude")
    return t.archive.select("event_id", geo.valid_position(lat, lon).alias("plain"),
                            geo.valid_position(lat, lon, reject_origin=True).alias("strict"))


@query("fn15_record_score", f"""
SELECT event_id, CAST({' + '.join(f"CASE WHEN {S.present('CAST(' + c + ' AS VARCHAR)')} IS NOT NULL THEN 1 ELSE 0 END" for c in
 ('imo', 'callsign', 'name', 'cargo_type', 'destination', 'navigational_status', 'sog', 'cog'))} AS INTEGER) AS score
FROM v_archive""")
def _(t):
    return t.archive.select("event_id", records.record_score(t.archive.columns).alias("score"))


@query("fn16_identity_keys", f"""
SELECT event_id, {S.ID_MERGE} AS id_merge, {S.ID_DEDUPE} AS id_dedupe, {S.ID_COMMON} AS id_common, {S.ID_TRACK} AS id_track,
 {S.ID_HISTORY} AS id_history FROM v_history""")
def _(t):
    return t.history.select("event_id", identity.id_merge().alias("id_merge"), identity.id_dedupe().alias("id_dedupe"),
                            identity.id_common().alias("id_common"), identity.id_track().alias("id_track"),
                            identity.id_history().alias("id_history"))


@query("fn16_identity_grid", f"""
SELECT DISTINCT vessel_id, coalesce('imo:' || {S.sized('imo', 7)}, 'mmsi:' || {S.sized('mmsi', 9)}, 'gfw:' || vessel_id) AS id_grid
FROM v_grid""")
def _(t):
    return t.grid.select("vessel_id", identity.id_grid().alias("id_grid")).distinct()


@query("fn17_record_ids", """
SELECT event_id, 'sar_' || substr(sha1(provider || '|' || mmsi), 1, 18) AS short,
 substr(sha256(mmsi || '|' || destination), 1, 24) AS event, sha256('{"mmsi":"' || mmsi || '","provider":"' || provider || '"}') AS full
FROM v_contacts""")
def _(t):
    return t.contacts.select(
        "event_id", records.short_sha1("sar_", F.col("provider"), F.col("mmsi")).alias("short"),
        records.event_id(F.col("mmsi"), F.col("destination")).alias("event"),
        records.row_sha256(F.struct("mmsi", "provider")).alias("full"))


@query("fn18_slot_dedupe_key", f"""
SELECT event_id, '2024-01-30T20:00:00Z|' || coalesce({S.digits('mmsi')}, '') || '|' || coalesce({S.digits('imo')}, '') || '|'
 || list_aggregate(list_sort([provider, 'watchlist']), 'string_agg', ',') AS key FROM v_contacts""")
def _(t):
    slot = times.slot_label(t.as_of - F.expr("INTERVAL 1 HOUR"))
    return t.contacts.select("event_id", records.slot_dedupe_key(slot, "mmsi", "imo", F.array(
        F.col("provider"), F.lit("watchlist"))).alias("key"))


@query("fn19_haversine", f"""
SELECT event_id, round({S.haversine_nm('longitude', 'latitude', '12e0', '56e0')}, 5) AS nm,
 round({S.haversine_m('longitude', 'latitude', '12e0', '56e0')}, 2) AS m FROM v_contacts""")
def _(t):
    xy = (F.col("longitude"), F.col("latitude"), F.lit(12.0), F.lit(56.0))
    return t.contacts.select("event_id", F.round(geo.haversine_nm(*xy), 5).alias("nm"),
                             F.round(geo.haversine_m(*xy), 2).alias("m"))


_ARC = f"((sog * 1852e0) / {P.EARTH_RADIUS_M})"
_SINP2 = (f"(sin(radians(latitude)) * cos({_ARC}) + cos(radians(latitude)) * sin({_ARC}) * cos(radians(cog)))")


@query("fn20_bearing_destination", f"""
SELECT event_id, round({S.bearing('longitude', 'latitude', '12e0', '56e0')}, 5) AS bearing,
 round(degrees(asin({_SINP2})), 7) AS dest_lat,
 round({S.fmod(f"degrees(radians(longitude) + atan2(sin(radians(cog)) * sin({_ARC}) * cos(radians(latitude)), cos({_ARC}) - sin(radians(latitude)) * sin(asin({_SINP2})))) + 54e1", '36e1')} - 18e1, 7) AS dest_lon,
 round(abs({S.fmod('cog - true_heading + 18e1', '36e1')} - 18e1), 5) AS difference FROM v_contacts""")
def _(t):
    lon, lat = geo.destination(F.col("longitude"), F.col("latitude"), F.col("cog"), F.col("sog") * 1852.0)
    return t.contacts.select(
        "event_id", F.round(geo.bearing(F.col("longitude"), F.col("latitude"), F.lit(12.0), F.lit(56.0)), 5).alias("bearing"),
        F.round(lat, 7).alias("dest_lat"), F.round(lon, 7).alias("dest_lon"),
        F.round(geo.angular_difference(F.col("cog"), F.col("true_heading")), 5).alias("difference"))


@query("fn21_point_segment_nm", f"""
SELECT event_id, round({S.segment_nm('longitude', 'latitude', '12e0', '55e0', '14e0', '56e0')}, 6) AS nm FROM v_contacts""")
def _(t):
    d = geo.point_segment_nm(F.col("longitude"), F.col("latitude"), F.lit(12.0), F.lit(55.0), F.lit(14.0), F.lit(56.0))
    return t.contacts.select("event_id", F.round(d, 6).alias("nm"))


@query("fn22_expand_bbox", """
SELECT event_id, round(longitude - sog / (6e1 * greatest(1e-1, cos(radians((latitude + latitude + 1e0) / 2e0)))), 7) AS west,
 round(latitude - sog / 6e1, 7) AS south, round(longitude + 1e0 + sog / (6e1 * greatest(1e-1, cos(radians((latitude + latitude
 + 1e0) / 2e0)))), 7) AS east, round(latitude + 1e0 + sog / 6e1, 7) AS north FROM v_contacts""")
def _(t):
    lon, lat = F.col("longitude"), F.col("latitude")
    box = geo.expand_bbox(lon, lat, lon + 1.0, lat + 1.0, F.col("sog"))
    return t.contacts.select("event_id", *[F.round(b, 7).alias(n) for b, n in zip(box, ("west", "south", "east", "north"))])


@query("fn23_pixel_lonlat", """
SELECT scene_id, px_row, px_col, round(8e0 + ((px_col + 5e-1) / 64) * 2e0, 7) AS lon, round(56e0 - ((px_row + 5e-1) / 64) * 2e0, 7) AS lat,
 round((56e0 - round(56e0 - ((px_row + 5e-1) / 64) * 2e0, 7)) / 2e0 * 64 - 5e-1, 3) AS back_row FROM v_pixels""")
def _(t):
    lon, lat = geo.pixel_to_lonlat(F.col("px_row"), F.col("px_col"), 64, 64, *map(F.lit, (8.0, 54.0, 10.0, 56.0)))
    row, _col = geo.lonlat_to_pixel(lon, lat, 64, 64, *map(F.lit, (8.0, 54.0, 10.0, 56.0)))
    return t.pixels.select("scene_id", "px_row", "px_col", lon.alias("lon"), lat.alias("lat"),
                           F.round(row, 3).alias("back_row"))


def _cats(df):
    c = F.col("event_id")
    return df.withColumn("cats", F.array_compact(F.array(
        F.when(c % 2 == 0, "watchlist"), F.when(c % 3 == 0, "russian_mmsi"), F.when(c % 5 == 0, "sanctions_shadowfleet"),
        F.when(c % 7 == 0, "neutral_tanker_context"))))


@query("fn24_primary_category", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'sanctions_shadowfleet' WHEN event_id % 3 = 0 THEN 'russian_mmsi' WHEN event_id % 2 = 0
 THEN 'watchlist' WHEN event_id % 7 = 0 THEN 'neutral_tanker_context' ELSE 'watchlist' END AS ranked,
CASE WHEN event_id % 5 = 0 THEN 'sanctions_shadowfleet' WHEN event_id % 2 = 0 THEN 'watchlist' WHEN event_id % 3 = 0 THEN 'russian_mmsi'
 WHEN event_id % 7 = 0 THEN 'neutral_tanker_context' WHEN timestamp_valid THEN 'watchlist' ELSE 'neutral_tanker_context' END AS shown
FROM v_contacts""")
def _(t):
    return _cats(t.contacts).select("event_id", records.primary_category(F.col("cats")).alias("ranked"),
                                    records.viewer_category(F.col("cats"), F.col("timestamp_valid")).alias("shown"))


@query("fn25_provider_label", """
SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'barentswatch' WHEN event_id % 6 = 1 THEN 'ais_dk_historical'
 WHEN event_id % 6 = 2 THEN 'global_fishing_watch' WHEN event_id % 6 = 3 THEN 'unknown' ELSE provider END AS label FROM v_contacts""")
def _(t):
    k = F.col("event_id") % 6
    raw = F.when(k == 0, "Norwegian Coastal Administration").when(k == 1, "Danish historical AIS").when(
        k == 2, "via GFW api").when(k == 3, "gfwx feed").otherwise(F.upper("provider"))
    return t.contacts.select("event_id", text.provider_label(raw).alias("label"))


@query("fn26_priority_flag", """
SELECT event_id, event_id % 2 = 0 OR event_id % 3 = 0 OR event_id % 5 = 0 OR (NOT timestamp_valid AND event_id % 7 <> 0) AS priority
FROM v_contacts""")
def _(t):
    return _cats(t.contacts).select("event_id", records.priority_flag(F.col("cats"), ~F.col("timestamp_valid")).alias("priority"))


@query("fn27_quality_struct", """
SELECT event_id, event_id % 9 = 0 AS timestamp_repaired, CAST(sog AS DOUBLE) >= 102.2 AS sog_invalid_sentinel, CAST(cog AS DOUBLE) >= 360
 AS cog_invalid_sentinel, CAST(heading AS DOUBLE) >= 511 AS heading_invalid_sentinel, CAST(latitude AS DOUBLE) BETWEEN -90 AND 90
 AS has_valid_position FROM v_archive""")
def _(t):
    basis = F.when(F.col("event_id") % 9 == 0, "retrieval_time_fallback").otherwise("source_timestamp")
    valid = geo.valid_position(text.parse_float("latitude"), text.parse_float("longitude"))
    return t.archive.select("event_id", records.quality_struct(basis, "sog", "cog", "heading", valid).alias("q")).select(
        "event_id", "q.*")


@query("fn28_prune_properties", """
SELECT p_partkey, unnest(['name', 'type', 'brand_code', 'size_class', 'owner_country_name_long']) AS key,
 unnest([p_name, p_type, p_brand, CAST(p_size AS VARCHAR), 'too long']) AS value FROM part""")
def _(t):
    props = F.create_map(F.lit("name"), F.col("p_name"), F.lit("type"), F.col("p_type"), F.lit("brand_code"), F.col("p_brand"),
                         F.lit("size_class"), F.col("p_size").cast("string"), F.lit("xyz"), F.lit("dropped"), F.lit("_id"),
                         F.lit("dropped"), F.lit("owner_country_name_long"), F.lit("too long"), F.lit("link"), F.lit(""))
    pruned = text.prune_properties("props")
    return t.table("part").withColumn("props", props).select("p_partkey", F.explode(pruned).alias("key", "value"))


@query("fn29_round_coordinate", """
SELECT event_id, round(latitude + value / 7e6, 5) AS lat, round(longitude - value / 7e6, 5) AS lon FROM v_contacts""")
def _(t):
    return t.contacts.select(
        "event_id", geo.round_coordinate(F.col("latitude") + F.col("value") / 7e6).alias("lat"),
        geo.round_coordinate(F.col("longitude") - F.col("value") / 7e6).alias("lon"))


@query("fn30_feature_name", """
SELECT feature_id, CASE CAST(feature_id AS INTEGER) % 3 WHEN 0 THEN s_name WHEN 1 THEN 'T' || feature_id ELSE feature_id END AS name
FROM v_infra""")
def _(t):
    k = F.col("feature_id").cast("int") % 3
    props = F.create_map(F.lit("Name"), F.when(k == 0, F.col("s_name")).otherwise("  "), F.lit("Title"),
                         F.when(k == 1, F.concat(F.lit("T"), "feature_id")).otherwise(""))
    return t.infra.withColumn("props", props).select("feature_id", text.feature_name("props", "feature_id").alias("name"))


@query("fn31_snapshot_tone", f"""
SELECT event_id, CASE WHEN provider = 'aisstream' THEN 'red' WHEN epoch(TIMESTAMP '{AS_OF}' - observed_at) / 3600e0 > 72 THEN 'red'
 WHEN timestamp_valid AND epoch(TIMESTAMP '{AS_OF}' - observed_at) / 3600e0 <= 30 THEN 'green' ELSE 'orange' END AS tone
FROM v_contacts""")
def _(t):
    snap = F.when(F.col("provider") != "aisstream", F.col("observed_at"))
    return t.contacts.select("event_id", records.snapshot_tone(F.col("observed_at"), snap, F.col("timestamp_valid"), t.as_of,
                                                               30.0, 72.0).alias("tone"))


@query("fn32_scene_id", """
SELECT p_partkey, 'S1C_' || upper(p_type) || '_' || CAST(p_partkey AS VARCHAR) AS scene FROM part""")
def _(t):
    k = F.col("p_partkey") % 3
    raw = F.concat(F.lit("  s1c_"), "p_type", F.lit("_"), F.col("p_partkey").cast("string"), F.when(k == 0, ".SAFE").when(
        k == 1, "_cog.safe").otherwise(""))
    return t.table("part").select("p_partkey", text.scene_id(raw).alias("scene"))


@query("fn33_scene_summary", """
SELECT CAST(p_partkey AS VARCHAR) AS item_id, CASE WHEN p_partkey % 2 = 0 THEN 'grd' ELSE 'sentinel-1-grd' END AS collection,
 CASE WHEN p_partkey % 3 = 0 THEN 'start' ELSE 'mid' END AS start_datetime, p_brand AS platform,
 CASE WHEN p_size % 2 = 0 THEN p_size END AS product_size FROM part""")
def _(t):
    k = F.col("p_partkey")
    items = t.table("part").select(
        k.cast("string").alias("id"), F.when(k % 2 == 0, "grd").alias("collection"),
        F.create_map(F.lit("datetime"), F.lit("mid"), F.lit("start_datetime"), F.when(k % 3 == 0, "start"),
                     F.lit("platform"), F.col("p_brand")).alias("properties"),
        F.create_map(F.lit("Product"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).otherwise(0), F.lit("vv"), F.lit(-1)
                     ).alias("assets"))
    return reference.scene_summary(items).select("item_id", "collection", "start_datetime", "platform",
                                                 F.col("product_size_bytes").cast("int").alias("product_size"))


@query("fn34_feed_contacts", f"""
SELECT provider, mmsi, coalesce({S.present('imo')}, '') AS imo, count(*) AS n, round(sum(latitude), 4) AS lat, round(sum(sog), 4) AS sog
FROM v_contacts WHERE provider IN ('fintraffic', 'barentswatch') GROUP BY ALL""")
def _(t):
    c = t.contacts.where(F.col("provider").isin("fintraffic", "barentswatch"))
    place = F.struct(F.array("longitude", "latitude").alias("coordinates"))
    props = F.struct(F.col("mmsi"), F.col("imo"), F.col("sog"), F.unix_millis("observed_at").alias("time"))
    rec = F.to_json(F.when(F.col("provider") == "fintraffic", F.struct(
        props.alias("properties"), place.alias("geometry"), F.lit(None).cast("string").alias("mmsi"),
        F.lit(None).cast("string").alias("imoNumber"), F.lit(None).cast("double").alias("speedOverGround"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"))).otherwise(F.struct(
            F.lit(None).cast(props_type(c)).alias("properties"), F.lit(None).cast("struct<coordinates:array<double>>").alias("geometry"),
            F.col("mmsi"), F.col("imo").alias("imoNumber"), F.col("sog").alias("speedOverGround"), F.col("latitude"),
            F.col("longitude"))))
    raw = c.select("provider", rec.alias("record"))
    fin = feeds.regional_contact(raw.where("provider = 'fintraffic'").select("record"), "fintraffic", t.as_of, t.as_of)
    bar = feeds.regional_contact(raw.where("provider = 'barentswatch'").select("record"), "barentswatch", t.as_of, t.as_of)
    return feeds.union_feeds(fin, bar).groupBy("provider", "mmsi", F.coalesce("imo", F.lit("")).alias("imo")).agg(
        F.count("*").alias("n"), F.round(F.sum("latitude"), 4).alias("lat"), F.round(F.sum("sog"), 4).alias("sog"))


def props_type(_df):
    return "struct<mmsi:string,imo:string,sog:double,time:bigint>"


@query("fn34_position_records", f"""
SELECT provider, {S.ID_COMMON} AS identity_key, count(*) AS n, count(*) FILTER (provider <> 'global_fishing_watch') AS exact
FROM v_contacts GROUP BY ALL""")
def _(t):
    c = t.contacts.withColumn("position_timestamp_valid", F.col("timestamp_valid")).withColumn(
        "position_timestamp_basis", F.lit(None).cast("string"))
    return feeds.position_record(c).groupBy("provider", "identity_key").agg(
        F.count("*").alias("n"), F.count_if("position_is_exact").alias("exact"))


