"""Filters and predicates."""

from pyspark.sql import functions as F

from wakeline import params as P

from wakeline.operators import filters, matching, reference
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import AS_OF, SCENE_AT
from wakeline.queries.registry import query
from wakeline.functions import geo
from wakeline.functions.records import is_tanker
from wakeline.functions.tables import fixed_table

PORT_TERMS = f"""terms AS (SELECT DISTINCT term, kind FROM (
 SELECT {S.norm_key('unlocode')} AS term, 'code' AS kind FROM v_ports
 UNION ALL SELECT {S.norm_key('port_name')}, 'name' FROM v_ports
 UNION ALL SELECT {S.norm_key('a')}, 'name' FROM (SELECT unnest(string_split_regex(aliases, '[;,|]')) AS a FROM v_ports)
 UNION ALL SELECT {S.norm_key('a')}, 'code' FROM (SELECT unnest(string_split_regex(aliases, '[;,|]')) AS a FROM v_ports)
  WHERE length({S.norm_key('a')}) = 5 AND {S.norm_key('a')} LIKE 'RU%'
 UNION ALL SELECT unnest([{S.quoted(P.PORT_CODE_ALLOWLIST)}]), 'code'
 UNION ALL SELECT {S.norm_key('n')}, 'name' FROM (SELECT unnest([{S.quoted(P.PORT_NAME_ALIASES)}]) AS n)) WHERE term IS NOT NULL)"""


def port_ctes(name: str, column: str, source: str = "v_contacts") -> str:
    """CTEs ``<name>``: text, hits, matched for every distinct text of a column."""
    return f"""{name}_t AS (SELECT DISTINCT {column} AS text FROM {source} WHERE {S.present(column)} IS NOT NULL),
{name}_h AS (SELECT text, term, false AS denied FROM {name}_t, terms WHERE contains({S.norm_key('text')}, term)
  AND length(term) >= CASE kind WHEN 'code' THEN 5 ELSE 4 END
 UNION SELECT text, n, true FROM {name}_t, (SELECT unnest([{S.quoted(P.PORT_NAME_DENYLIST)}]) AS n) WHERE contains({S.norm_key('text')}, n)
 UNION SELECT text, k, k IN ({S.quoted(P.PORT_CODE_DENYLIST)}) FROM (SELECT text, {S.norm_key('tok')} AS k FROM (SELECT text,
  unnest(regexp_extract_all({S.norm_text('text')}, '([A-Z]{{2}}\\s?[A-Z0-9]{{3}})', 1)) AS tok FROM {name}_t))
  WHERE k IN ({S.quoted(P.PORT_CODE_DENYLIST)}) OR k IN (SELECT term FROM terms WHERE kind = 'code')),
{name} AS (SELECT text, string_agg(DISTINCT term, ',' ORDER BY term) AS hits, bool_or(NOT denied) AS matched FROM {name}_h GROUP BY text)"""


@query("flt01_active_rows", """
SELECT line_no, name FROM v_watchlist WHERE lower(active) NOT IN ('0', 'false', 'no', 'n')
 AND NOT regexp_matches(lower(name || ' ' || notes || ' ' || source_list), 'test_only|example|dummy|sample')""")
def _(t):
    return filters.drop_inactive(t.watchlist, "active", "name", "notes", "source_list").select("line_no", "name")


REJECT = f"""CASE WHEN column_count <> 26 THEN 'wrong_column_count' WHEN lower(timestamp) = 'timestamp' THEN 'header'
 WHEN regexp_replace(lower(type_of_mobile), '\\s+', ' ', 'g') NOT IN ('class a', 'class b') THEN 'non_vessel_mobile_type'
 WHEN length({S.digits('mmsi')}) <> 9 THEN 'invalid_mmsi' WHEN NOT regexp_matches(timestamp, '^../../.... ..:..:..$') THEN 'invalid_timestamp'
 WHEN CAST(latitude AS DOUBLE) = 0 AND CAST(longitude AS DOUBLE) = 0 THEN 'invalid_position' END"""


@query("flt02_archive_reject_reason", f"SELECT event_id, {REJECT} AS reason FROM v_archive")
def _(t):
    return t.archive.select("event_id", filters.archive_reject_reason(F.col("column_count")).alias("reason"))


@query("flt03_keep_contact", f"""
WITH {PORT_TERMS}, {port_ctes('d', 'destination')}, {port_ctes('p', 'last_port')}, k AS (
SELECT event_id, mmsi LIKE '273%' AS russian_mmsi,
 coalesce({S.digits('imo')} IN (SELECT {S.digits('imo')} FROM v_watchlist WHERE {S.digits('imo')} IS NOT NULL), false)
 OR coalesce({S.digits('mmsi')} IN (SELECT {S.digits('mmsi')} FROM v_watchlist WHERE {S.digits('mmsi')} IS NOT NULL), false)
 OR coalesce({S.norm_text('callsign')} IN (SELECT {S.norm_text('callsign')} FROM v_watchlist WHERE {S.norm_text('callsign')} IS NOT NULL), false) AS watchlisted,
 substr(mmsi, 1, 3) IN ({S.quoted(P.MID_FLAGS)}) AS risk_mid,
 coalesce(d.matched, false) OR coalesce(p.matched, false) AS port_hit,
 {S.TANKER} AND EXISTS (SELECT 1 FROM (VALUES {S.ZONE_VALUES}) z(id, s, n, w, e) WHERE latitude BETWEEN s AND n AND longitude BETWEEN w AND e) AS tanker_zone
, event_id % 31 = 0 AS recent_port_call
FROM v_contacts LEFT JOIN d ON d.text = destination LEFT JOIN p ON p.text = last_port)
SELECT *, russian_mmsi OR watchlisted OR risk_mid OR port_hit OR tanker_zone OR recent_port_call AS keep FROM k""")
def _(t):
    mids = fixed_table(t.spark, ("mid",), [(m,) for m in P.MID_FLAGS])
    flagged = t.contacts.withColumns({"recent_unconfirmed": F.col("event_id") % 62 == 0, "recent_confirmed": F.col("event_id") % 62 == 31})
    return matching.keep_flags(flagged, t.watchlist, matching.port_terms(t.ports), mids).select(
        "event_id", "russian_mmsi", "watchlisted", "risk_mid", "port_hit", "tanker_zone", "recent_port_call", "keep")


@query("flt04_tanker", f"SELECT event_id, {S.TANKER} AS tanker FROM v_contacts")
def _(t):
    return t.contacts.select("event_id", is_tanker("ship_type", "ship_type_text", "destination").alias("tanker"))


@query("flt05_gateway_area", f"SELECT event_id, {S.GATEWAY} AS area FROM v_contacts")
def _(t):
    return t.contacts.select("event_id", geo.in_gateway_area(F.col("latitude"), F.col("longitude")).alias("area"))


WINDOW_MIN = 720


@query("flt06_scene_window", f"""
SELECT event_id FROM v_contacts WHERE observed_at BETWEEN TIMESTAMP '{SCENE_AT}' - INTERVAL {WINDOW_MIN} MINUTE
 AND TIMESTAMP '{SCENE_AT}' + INTERVAL {WINDOW_MIN} MINUTE AND CAST(observed_at AS DATE) = DATE '{SCENE_AT[:10]}'""")
def _(t):
    return t.contacts.where(filters.in_scene_window(F.col("observed_at"), t.scene_at, WINDOW_MIN)).select("event_id")


_GAP = f"abs(epoch_us(observed_at) - epoch_us(TIMESTAMP '{SCENE_AT}')) / 36e8"
_RADIUS = f"(2000e0 / 1852e0 + (CASE WHEN sog BETWEEN 0 AND 102.1 THEN least(102.1e0, sog + 5e0) ELSE 4e1 END) * {_GAP} + 1e0)"


@query("flt07_extraction_guard", f"""
SELECT event_id FROM v_contacts WHERE latitude BETWEEN 56e0 - {_RADIUS} / 6e1 AND 57e0 + {_RADIUS} / 6e1
 AND longitude BETWEEN 12e0 - {_RADIUS} / (6e1 * cos(radians(56.5e0))) AND 14e0 + {_RADIUS} / (6e1 * cos(radians(56.5e0)))""")
def _(t):
    gap = F.abs(F.unix_micros("observed_at") - F.unix_micros(t.scene_at)) / 3.6e9
    inside = filters.inside_guard(F.col("longitude"), F.col("latitude"), *map(F.lit, (12.0, 56.0, 14.0, 57.0)),
                                  F.col("sog"), gap, P.MatchParams())
    return t.contacts.where(inside).select("event_id")


@query("flt08_retention", f"""
SELECT CASE WHEN seen_at IS NULL THEN 'missing_timestamp' WHEN seen_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN 'outside_window'
 WHEN seen_at > TIMESTAMP '{AS_OF}' + INTERVAL 24 HOUR THEN 'future_timestamp' ELSE 'kept' END AS reason, count(*) AS n
FROM v_history GROUP BY ALL""")
def _(t):
    return filters.reject_counts(t.history, filters.retention_reject(F.col("seen_at"), t.as_of, 14, 24))


@query("flt09_provider_ttl", f"""
WITH g AS (SELECT provider, user_id, max(observed_at) AS generated_at FROM v_contacts WHERE provider IN ('aisstream', 'fintraffic', 'barentswatch')
 GROUP BY ALL), a AS (SELECT *, epoch_us(TIMESTAMP '{AS_OF}' - generated_at) / 36e8 AS h FROM g)
SELECT provider, user_id, round(h, 2) AS age_hours, h > CASE provider WHEN 'aisstream' THEN 40 ELSE 30 END AS stale,
 h <= CASE provider WHEN 'aisstream' THEN 96 ELSE 72 END AS included FROM a""")
def _(t):
    feeds = t.contacts.where(F.col("provider").isin("aisstream", "fintraffic", "barentswatch")).groupBy(
        "provider", "user_id").agg(F.max("observed_at").alias("generated_at"))
    return filters.ttl_status(feeds, "provider", "generated_at", t.as_of).drop("generated_at")


def _with_categories(t):
    c = F.col("event_id")
    return t.contacts.withColumn("categories", F.array_compact(F.array(
        F.when(c % 2 == 0, "watchlist"), F.when(c % 3 == 0, "russian_mmsi"), F.when(c % 5 == 0, "other"),
        F.when(c % 7 == 0, "neutral_tanker_context")))).withColumn("known_voi_match", c % 4 != 1)


@query("flt10_publish_known", """
SELECT event_id, concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'russian_mmsi' END, CASE WHEN event_id % 2 = 0 THEN 'watchlist' END) AS categories
FROM v_contacts WHERE event_id % 4 <> 1 AND (event_id % 2 = 0 OR event_id % 3 = 0)""")
def _(t):
    return filters.publish_known(_with_categories(t)).select("event_id", F.array_join("categories", ",").alias("categories"))


@query("flt11_priority_filter", "SELECT event_id, mmsi FROM v_history WHERE is_priority_voi")
def _(t):
    return t.history.where("is_priority_voi").select("event_id", "mmsi")


@query("flt12_map_layers", """
WITH b AS (SELECT event_id, mmsi, event_id % 2 = 0 AS w, event_id % 3 = 0 AS r, event_id % 7 = 0 AS n, event_id % 4 <> 1 AS k,
 track FROM (SELECT *, event_id % 10 = 3 AS track FROM v_contacts)), s AS (SELECT *, w OR r OR k OR track AS shown FROM b)
SELECT event_id, unnest([x FOR x IN [CASE WHEN shown THEN 'vessel_positions' END, CASE WHEN n AND NOT shown THEN 'neutral_tanker_context' END,
 CASE WHEN track THEN 'sanctions_shadowfleet' END, CASE WHEN w OR k THEN 'watchlist' END, CASE WHEN r OR mmsi LIKE '273%' THEN 'russian_mmsi' END]
 IF x IS NOT NULL]) AS layer FROM s""")
def _(t):
    rows = _with_categories(t).withColumn("sanctioned", F.col("event_id") % 10 == 3)
    flags = {"known_voi_match": F.col("known_voi_match"), "sanctioned": F.col("sanctioned")}
    layers = filters.map_layers(F.col("categories"), flags, F.col("mmsi"), F.lit(False))
    return rows.select("event_id", F.explode(layers).alias("layer"))


@query("flt13_event_time", f"SELECT event_id FROM v_contacts WHERE observed_at >= TIMESTAMP '{AS_OF}' - INTERVAL 120 HOUR")
def _(t):
    return t.contacts.where(F.col("observed_at") >= t.as_of - F.expr("INTERVAL 120 HOUR")).select("event_id")


@query("flt14_radar_roles", """
SELECT region_id, ais_matched, count(*) AS n FROM v_grid WHERE vessel_id LIKE 'v1%' AND NOT (ais_matched AND detections <= 2) GROUP BY ALL""")
def _(t):
    rows = t.grid.withColumn("role", F.when(F.col("ais_matched") & (F.col("detections") <= 2), "sar_ais_connector").otherwise(
        "sar_detection"))
    shown = filters.role_visible(F.col("role"), F.col("ais_matched"), F.coalesce(F.col("vessel_id").startswith("v1"), F.lit(False)),
                                 show_connectors=False, watch_only=True)
    return rows.where(shown).groupBy("region_id", "ais_matched").agg(F.count("*").alias("n"))


@query("flt15_feature_box", """
SELECT feature_id, round(a_lon, 6) AS west, round(a_lat, 6) AS south, round(b_lon, 6) AS east, round(b_lat, 6) AS north FROM v_infra
WHERE NOT (b_lon < 10 OR a_lon > 20 OR b_lat < 55 OR a_lat > 57)""")
def _(t):
    ends = F.explode(F.array(F.struct(F.col("a_lon").alias("lon"), F.col("a_lat").alias("lat")),
                             F.struct(F.col("b_lon").alias("lon"), F.col("b_lat").alias("lat"))))
    verts = t.infra.select("feature_id", ends.alias("v")).select("feature_id", "v.*")
    return reference.features_in_box(verts, (10.0, 55.0, 20.0, 57.0)).select(
        "feature_id", *[F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")])


@query("flt16_regional_providers", "SELECT event_id, provider FROM v_contacts WHERE provider IN ('fintraffic', 'barentswatch')")
def _(t):
    return t.contacts.where(F.col("provider").isin("fintraffic", "barentswatch")).select("event_id", "provider")


