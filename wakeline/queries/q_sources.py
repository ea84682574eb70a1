"""Readers, feed dialects and sinks. File round trips go through the shared scratch folder."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import params as P
from wakeline.operators import merge, radar
from wakeline.queries import fragments as S
from wakeline.queries.q_history import kept
from wakeline.queries.q_matching import CLASSIFIED, classified
from wakeline.queries.q_merge import _TOP2, typed
from wakeline.queries.q_radar import STATES, correlated, CORR, pairs
from wakeline.queries.registry import query
from wakeline.session import checkpoint_dir
from wakeline.sources import feeds, readers, sinks

CONTACT = T.StructType([T.StructField(n, k) for n, k in (
    ("event_id", T.LongType()), ("mmsi", T.StringType()), ("imo", T.StringType()), ("destination", T.StringType()),
    ("latitude", T.DoubleType()))])
_FIELDS = ("event_id", "mmsi", "imo", "destination", "latitude")


def scratch(t) -> str:
    return f"{checkpoint_dir(t.spark)}/wakeline-{uuid.uuid4().hex}"


def contact_lines(t):
    """Contacts as JSON lines with broken, non-object and blank lines among them."""
    k = F.col("event_id") % 13
    line = F.when(k == 0, "{bad").when(k == 1, "[1, 2]").when(k == 2, "  ").otherwise(F.to_json(F.struct(*_FIELDS)))
    return t.contacts.select(line.alias("value"))


@query("src01_header_csv", "SELECT line_no, name, mmsi, active, NULL AS missing FROM v_watchlist")
def _(t):
    path = scratch(t)
    t.watchlist.select("line_no", "name", "mmsi", "active").write.option("header", True).csv(path)
    read = readers.read_header_csv(t.spark, path, ("line_no", "name", "mmsi", "active", "missing"))
    none = readers.read_header_csv(t.spark, path + "-absent", ("line_no", "name", "mmsi", "active", "missing"))
    return read.unionByName(none).select(F.col("line_no").cast("bigint").alias("line_no"), "name", F.coalesce("mmsi", F.lit("")).alias("mmsi"),
                                         "active", "missing")


@query("src02_positional_csv", """
SELECT CASE WHEN event_id % 501 = 0 OR event_id % 26 = 0 THEN 0 ELSE 26 END AS column_count, count(*) AS n, count(*) FILTER (lower(timestamp) = 'timestamp' AND event_id % 501 <> 0 AND event_id % 26 <> 0) AS headers,
 count(*) FILTER (event_id % 26 = 13 AND event_id % 501 <> 0) AS quoted FROM v_archive GROUP BY 1""")
def _(t):
    path = scratch(t)
    line = F.concat_ws(",", *P.ARCHIVE_COLUMNS)
    # Every 501st row lost most of its fields; in every 13th, quotes hold one field with a comma, or make 26 of 25.
    quoted = F.concat_ws(",", *[F.lit('"A,B"') if c == "destination" else F.col(c) for c in P.ARCHIVE_COLUMNS])
    short = F.concat_ws(",", *[F.lit('"A,B"') if c == "destination" else F.col(c) for c in P.ARCHIVE_COLUMNS[:-1]])
    text = (F.when(F.col("column_count") == 25, F.concat_ws(",", "timestamp", "type_of_mobile", "mmsi"))
            .when(F.col("event_id") % 26 == 13, quoted).when(F.col("event_id") % 26 == 0, short).otherwise(line))
    t.archive.select(text.alias("value")).write.text(path)
    rows = readers.read_archive_csv(t.spark, path)
    width = F.when(F.col("column_count") == 26, 26).otherwise(0)
    return rows.groupBy(width.alias("column_count")).agg(F.count("*").alias("n"), F.count_if(
        (F.lower("timestamp") == "timestamp") & (F.col("column_count") == 26)).alias("headers"),
        F.count_if((F.col("destination") == "A,B") & (F.col("column_count") == 26)).alias("quoted"))


def _envelope(t, wrapper):
    """One file per provider holding an object with its contacts."""
    rows = F.struct(*_FIELDS)
    body = F.concat(F.lit('{"generated_at":"x","' + wrapper + '":'), F.to_json(F.array(rows)), F.lit("}"))
    return t.contacts.select(body.alias("value"))


@query("src03_json_envelope", f"SELECT {', '.join(_FIELDS[:4])}, round(latitude, 6) AS latitude FROM v_contacts")
def _(t):
    rows = readers.envelope_rows(_envelope(t, "vessels"), CONTACT)
    return rows.withColumn("latitude", F.round("latitude", 6))


@query("src03_json_envelope_files", f"SELECT {', '.join(_FIELDS[:4])}, round(latitude, 6) AS latitude FROM v_contacts")
def _(t):
    path = scratch(t)
    listed = t.contacts.repartition(4, "user_id").groupBy(F.spark_partition_id(), (F.col("event_id") % 100).alias("b")).agg(
        F.to_json(F.collect_list(F.struct(*_FIELDS))).alias("l"))
    listed.select(F.concat(F.lit('{"contacts":'), "l", F.lit("}")).alias("value")).repartition(50).write.option(
        "maxRecordsPerFile", 1).text(path)
    rows = readers.read_contacts(t.spark, [path + "-absent", path], CONTACT)
    return rows.select(*_FIELDS[:4], F.round("latitude", 6).alias("latitude"))


@query("src04_tolerant_jsonl", f"""
SELECT 'row' AS kind, event_id, mmsi, destination FROM v_contacts WHERE event_id % 13 > 2 UNION ALL SELECT 'reject', NULL, CASE event_id % 13 WHEN 0 THEN '{{bad' ELSE '[1, 2]' END, NULL FROM v_contacts WHERE event_id % 13 < 2""")
def _(t):
    path = scratch(t)
    contact_lines(t).write.text(path)
    rows, bad = readers.read_jsonl(t.spark, path, CONTACT)
    return rows.select(F.lit("row").alias("kind"), "event_id", "mmsi", "destination").unionByName(bad.select(
        F.lit("reject").alias("kind"), F.lit(None).cast("bigint").alias("event_id"), F.col("value").alias("mmsi"),
        F.lit(None).cast("string").alias("destination")))


@query("src05_manifest_shards", "SELECT count(*) AS n, sum(event_id)::BIGINT AS ids FROM v_contacts WHERE event_id % 13 > 2")
def _(t):
    root = scratch(t)
    lines = contact_lines(t)
    lines.write.text(root + "/voi-history-a.jsonl")
    t.spark.range(1).select(F.lit('{"parts":[{"filename":"voi-history-a.jsonl"}]}').alias("value")).coalesce(1).write.text(
        root + "/manifest.json")
    # A loose shard the manifest does not list must not be read.
    lines.write.text(root + "/voi-history-b.jsonl")
    rows, _bad = readers.read_history(t.spark, root, root + "/legacy.jsonl", CONTACT)
    return rows.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def _collections(t):
    """One FeatureCollection text per part row with a point and a polygon."""
    x, y = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    point = F.concat(F.lit('{"id":"f'), x, F.lit('","properties":{"name":"P'), x, F.lit('"},"geometry":{"type":"Point","coordinates":['),
                     y, F.lit(","), y, F.lit("]}}"))
    poly = F.concat(F.lit('{"properties":{"id":"r'), x, F.lit('"},"geometry":{"type":"Polygon","coordinates":[[[0,0],['), y,
                    F.lit(",0],["), y, F.lit(","), y, F.lit("],[0,0]]]}}"))
    return t.table("part").select("p_partkey", F.concat(F.lit('{"type":"FeatureCollection","features":['), point, F.lit(","), poly,
                                                        F.lit("]}")).alias("value"))


@query("src06_geojson_features", """
SELECT 'f' || p_partkey AS feature_id, 'Point' AS geometry_type, 'P' || p_partkey AS name FROM part UNION ALL SELECT 'pipeline:1', 'Polygon', NULL FROM part""")
def _(t):
    rows = readers.feature_rows(_collections(t), "pipeline")
    return rows.select("feature_id", "geometry_type", F.col("properties")["name"].alias("name"))


@query("src06_geojson_file", """
SELECT coalesce(CASE WHEN p_partkey % 5 <> 0 THEN 'f' || p_partkey END, 'layer:' || (row_number() OVER (ORDER BY p_partkey) - 1)) AS feature_id, 'P},' || p_partkey AS name,
  row_number() OVER (ORDER BY p_partkey) - 1 AS index, p_size AS size FROM part""")
def _(t):
    """One large file, read by many tasks."""
    path = scratch(t)
    key = F.col("p_partkey")
    one = F.to_json(F.struct(F.when(key % 5 != 0, F.concat(F.lit("f"), key.cast("string"))).alias("id"), F.struct(
        F.concat(F.lit("P},"), key.cast("string")).alias("name"), F.col("p_size").alias("size")).alias("properties"), F.struct(
        F.lit("Point").alias("type"), F.array(F.lit(1.0), F.lit(2.0)).alias("coordinates")).alias("geometry")))
    lines = t.table("part").select(key.alias("k"), F.concat(one, F.lit(",")).alias("value"))
    ends = t.spark.sql("""SELECT * FROM VALUES (-1, '{"crs":{"name":"x"},"features":['), (9223372036854775807, '{}],"more":{"features":[]}}') AS e(k, value)""")
    # The last element is empty: it has no name.
    lines.unionByName(ends.select(F.col("k").cast("bigint"), "value")).repartition(1).sortWithinPartitions("k").select("value").write.text(path)
    rows = readers.read_geojson(t.spark, {"layer": path, "absent": path + "-absent"}).where("properties IS NOT NULL")
    return rows.select("feature_id", F.col("properties")["name"].alias("name"), "index", F.col("properties")["size"].cast("int").alias("size"))


@query("src11_region_polygons", "SELECT 'r' || p_partkey AS region_id, 'r' || p_partkey AS region_name FROM part")
def _(t):
    return readers.region_rows(readers.feature_rows(_collections(t), "region")).select("region_id", "region_name")


@query("src07_any_wrapper", "SELECT event_id, mmsi FROM v_contacts")
def _(t):
    one = F.to_json(F.struct("event_id", "mmsi"))
    k = F.col("event_id") % 4
    text = (F.when(k == 0, F.concat(F.lit("["), one, F.lit(", 5]"))).when(k == 1, F.concat(F.lit('{"locations":['), one, F.lit("]}")))
            .when(k == 2, F.concat(F.lit('{"features":'), F.lit("[" ), one, F.lit('],"data":[1]}'))).otherwise(one))
    records = readers.any_records(t.contacts.select(text.alias("value")))
    return records.select(F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id"),
                          F.get_json_object("record", "$.mmsi").alias("mmsi"))


def ais_messages(t):
    """Contacts as tagged-union feed messages."""
    kind = F.element_at(F.array(F.lit("PositionReport"), F.lit("ShipStaticData"), F.lit("StaticDataReport"),
                                F.lit("StandardClassBPositionReport"), F.lit("Other")), (F.col("event_id") % 5 + 1).cast("int"))
    meta = F.struct(F.col("mmsi").alias("MMSI"), F.lit(" Meta ").alias("ShipName"), F.lit(1.5).alias("latitude"), F.lit(2.5).alias("Longitude"),
                    F.lit("2024-01-01T00:00:00Z").alias("time_utc"))
    body = F.struct((F.col("user_id") + 1).alias("UserID"), F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"),
                    F.col("sog").alias("Sog"), F.col("imo").alias("ImoNumber"), F.col("destination").alias("Destination"),
                    F.struct(F.lit("Report A").alias("Name")).alias("ReportA"), F.struct(F.col("callsign").alias("CallSign")).alias("ReportB"))
    text = F.concat(F.lit('{"MessageType":"'), kind, F.lit('","MetaData":'), F.to_json(meta), F.lit(',"Message":{"'), kind, F.lit('":'),
                    F.to_json(body), F.lit("}}"))
    return t.contacts.select("event_id", text.alias("value"))


@query("src08_tagged_messages", f"""
SELECT event_id, CASE WHEN event_id % 5 = 4 THEN mmsi ELSE CAST(user_id + 1 AS VARCHAR) END AS mmsi, CASE WHEN event_id % 5 = 1 THEN {S.present('imo')} END AS imo,
 CASE event_id % 5 WHEN 2 THEN 'Report A' ELSE 'Meta' END AS name, CASE WHEN event_id % 5 = 2 THEN {S.present('callsign')} END AS callsign,
 round(CASE WHEN event_id % 5 IN (0, 3) THEN latitude ELSE 15e-1 END, 6) AS latitude, round(CASE WHEN event_id % 5 IN (0, 3) THEN longitude ELSE 25e-1 END, 6) AS longitude,
 CASE WHEN event_id % 5 IN (0, 3) THEN sog END AS sog, CASE WHEN event_id % 5 = 1 THEN {S.present('destination')} END AS destination FROM v_contacts""")
def _(t):
    return readers.message_contacts(ais_messages(t)).select(
        "event_id", "mmsi", "imo", "name", "callsign", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
        "sog", "destination")


def _reports(t):
    row = F.struct(F.lit("2024-01-01").alias("date"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("vessel_id").alias("vesselId"),
                   F.col("imo"), F.col("mmsi"), F.lit(None).cast("string").alias("callsign"), F.lit(None).cast("string").alias("shipName"),
                   F.lit(None).cast("string").alias("flag"), F.lit(None).cast("string").alias("vesselType"), F.col("detections").cast("double").alias("detections"),
                   F.col("hours"), F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("entryTimestamp"))
    key = F.when(F.col("ais_matched"), "public-global-presence:v1").otherwise("other:v2")
    return t.grid.select(F.array(F.map_from_arrays(F.array(key), F.array(F.array(row)))).alias("entries"))


@query("src09_grid_report", f"""
SELECT CASE WHEN ais_matched THEN 'public-global-presence:v1' ELSE 'other:v2' END AS source_dataset, CASE WHEN ais_matched THEN 'public-global-presence:v1' END AS dataset_version,
 count(*) AS n, round(sum(hours), 2) AS hours FROM v_grid GROUP BY ALL""")
def _(t):
    return readers.flatten_report(_reports(t)).groupBy("source_dataset", "dataset_version").agg(
        F.count("*").alias("n"), F.round(F.sum("hours"), 2).alias("hours"))


@query("fn34_grid_contacts", f"""
SELECT coalesce('imo:' || {S.sized('imo', 7)}, 'mmsi:' || {S.sized('mmsi', 9)}, 'gfw:' || vessel_id) AS identity_key, count(*) AS n, min(epoch(coalesce(observed_at, TIMESTAMP '2024-01-01')))::BIGINT AS first
FROM v_grid WHERE latitude <= 90 GROUP BY 1 HAVING identity_key IS NOT NULL""")
def _(t):
    rows = feeds.grid_contact(readers.flatten_report(_reports(t)))
    return rows.groupBy("identity_key").agg(F.count("*").alias("n"), F.min(F.unix_seconds("observed_at")).alias("first"))


def contacts_with_positions(t):
    two = merge.latest_two(typed(t), "mmsi", "observed_at", "event_id")
    return merge.contact_with_positions(two, "mmsi", "observed_at", ("latitude", "longitude", "destination"), ("latitude", "longitude"))


@query("src10_position_explode", f"""
WITH {_TOP2} SELECT mmsi, epoch(observed_at)::BIGINT AS sec, latitude, longitude FROM two WHERE rank <= 2""")
def _(t):
    rows = contacts_with_positions(t).select("mmsi", "latitude", "longitude", "positions")
    out = readers.explode_positions(rows, ("observed_at", "latitude", "longitude"))
    return out.select("mmsi", F.unix_seconds("observed_at").alias("sec"), "latitude", "longitude")


@query("src12_source_fallback", "SELECT 'limited' AS scope, false AS complete, count(*) AS n FROM v_contacts UNION ALL SELECT 'missing', NULL, 0")
def _(t):
    path = scratch(t)
    t.contacts.select(*_FIELDS).write.json(path)
    rows = readers.choose_source(t.spark, path + "-full", path, CONTACT)
    none = readers.choose_source(t.spark, path + "-full", path + "-other", CONTACT).agg(
        F.lit("missing").alias("scope"), F.bool_or("coverage_complete").alias("complete"), F.count("*").alias("n"))
    return rows.groupBy(F.col("coverage_scope").alias("scope"), F.col("coverage_complete").alias("complete")).agg(
        F.count("*").alias("n")).unionByName(none)


# --- sinks ---------------------------------------------------------------------------

_PROPS = ("mmsi", "imo", "name", "destination")


@query("snk01_point_layers", f"""
WITH {CLASSIFIED}, x AS (SELECT unnest(categories) AS layer, event_id FROM classified) SELECT layer, count(*) AS n FROM x WHERE layer IN ({S.quoted(P.CATEGORY_RANK)}) GROUP BY 1""")
def _(t):
    path = scratch(t)
    sinks.write_layers(classified(t), path, _PROPS, tuple(P.CATEGORY_RANK))
    return t.spark.read.text(path).where(F.get_json_object("value", "$.geometry.coordinates[1]").isNotNull()).groupBy("layer").agg(
        F.count("*").alias("n"))


@query("snk02_track_features", f"""
WITH {_TOP2}, l AS (SELECT * FROM two WHERE rank = 1), p AS (SELECT * FROM two WHERE rank = 2)
SELECT mmsi, 'latest_historical_position' AS role, NULL::DOUBLE AS distance_nm FROM l UNION ALL SELECT mmsi, 'previous_historical_position', NULL FROM p UNION ALL
SELECT l.mmsi, 'historical_two_position_connector', round({S.haversine_nm('p.longitude', 'p.latitude', 'l.longitude', 'l.latitude')}, 3) FROM l JOIN p USING (mmsi) WHERE l.latitude <> p.latitude OR l.longitude <> p.longitude""")
def _(t):
    return sinks.track_features(contacts_with_positions(t), "mmsi", "observed_at").select("mmsi", "role", "distance_nm")


@query("snk02_radar_connectors", f"""
WITH {CORR} SELECT 'sar_detection' AS role, count(*) AS n FROM cor UNION ALL SELECT unnest(['historical_ais_context', 'sar_ais_connector']), count(*) FROM cor WHERE status = 'time_aligned_same_identity'""")
def _(t):
    return sinks.connector_features(correlated(t)).groupBy("role").agg(F.count("*").alias("n"))


@query("snk03_day_shards", f"""
SELECT count(*) AS rows, count(DISTINCT history_key) AS keys FROM v_history WHERE seen_at BETWEEN TIMESTAMP '2024-01-17' AND TIMESTAMP '2024-02-01' AND event_id IN (SELECT arg_max(event_id, (seen_at, event_id)) FROM v_history
 WHERE seen_at BETWEEN TIMESTAMP '2024-01-17' AND TIMESTAMP '2024-02-01' GROUP BY history_key)""")
def _(t):
    path = scratch(t)
    rows = kept(t)
    sinks.write_shards(rows, path, "seen_at", "history_key", F.col("row_bytes"), 4000)
    return t.spark.read.schema(rows.schema).json(path).agg(F.count("*").alias("rows"), F.count_distinct("history_key").alias("keys"))


@query("snk04_csv_product", f"""
WITH {CLASSIFIED} SELECT event_id, mmsi, '[' || array_to_string([ '"' || x || '"' FOR x IN categories], ',') || ']' AS categories, NULL AS absent FROM classified""")
def _(t):
    path = scratch(t)
    sinks.write_csv(classified(t), path, ("event_id", "mmsi", "categories", "absent"))
    return t.spark.read.csv(path, header=True, escape='"', schema="event_id bigint, mmsi string, categories string, absent string")


@query("snk05_json_envelope", "SELECT count(*) AS n, (SELECT count(DISTINCT mmsi) FROM v_contacts) AS vessels FROM v_contacts")
def _(t):
    path = scratch(t)
    rows = t.contacts.select("event_id", "mmsi")
    sinks.write_envelope(rows, rows.agg(F.count_distinct("mmsi").alias("vessels")), path)
    meta = t.spark.read.json(path + "/meta")
    return t.spark.read.json(path + "/rows").agg(F.count("*").alias("n")).withColumn("vessels", meta.select("vessels").scalar())


@query("snk06_size_guard", """
SELECT count(*) AS rows, sum(length('{"mmsi":"' || mmsi || '","provider":"' || provider || '"}') + 1)::BIGINT AS bytes, true AS refused FROM v_contacts""")
def _(t):
    rows = t.contacts.select("mmsi", "provider")
    path = scratch(t)
    sinks.write_if_small(rows, path)
    refused = False
    try:
        sinks.write_if_small(rows.limit(1), path, 1)
    except ValueError:
        refused = True
    # The refused product left the last good one in place.
    return sinks.product_bytes(t.spark.read.json(path)).withColumn("refused", F.lit(refused))


@query("snk07_fan_out", f"WITH {CLASSIFIED} SELECT count(*) AS items, (SELECT count(*) FROM (SELECT unnest(categories) FROM classified)) AS features FROM classified")
def _(t):
    path = scratch(t)
    items = classified(t)
    stats = items.agg(F.count("*").alias("items"))
    sinks.fan_out(items, path, tuple(P.CATEGORY_RANK), _PROPS, stats)
    features = t.spark.read.text(path + "/layers").agg(F.count("*"))
    return t.spark.read.json(path + "/stats").withColumn("features", features.scalar())


@query("snk09_evidence_layers", f"WITH {STATES} SELECT detection_id, match_state, alternatives FROM st")
def _(t):
    enough = t.spark.range(1).select(F.lit(True).alias("sufficient"))
    states = radar.match_states(t.detections, pairs(t), enough)
    out = sinks.evidence_features(states, t.detections)
    return out.select("detection_id", F.get_json_object("value", "$.properties.match_state").alias("match_state"),
                      F.get_json_object("value", "$.properties.alternatives").cast("bigint").alias("alternatives"))


