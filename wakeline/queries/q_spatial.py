"""Geometry tables, grid joins and loitering near infrastructure."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.operators import proximity as px
from wakeline.operators import spatial as sp
from wakeline.operators.spatial import near_pairs
from wakeline.queries import fragments as S
from wakeline.queries.registry import query

# The given tracks are sparse (hours between points), so stays are also measured with a wide gap.
PARAMS = P.ProximityParams(maximum_gap_minutes=2880.0)
_SEG = S.segment_nm("c.longitude", "c.latitude", "i.a_lon", "i.a_lat", "i.b_lon", "i.b_lat")


def pairs_sql(radius: float) -> str:
    return f"""pr AS (SELECT c.event_id, c.mmsi, c.observed_at, c.sog, c.timestamp_valid, i.feature_id, i.infrastructure_type, {_SEG} AS d
 FROM v_contacts c JOIN v_infra i ON abs(c.latitude - (i.a_lat + i.b_lat) / 2e0) < 5e-2 + 1e-2 AND abs(c.longitude - (i.a_lon + i.b_lon) / 2e0) < 2e-1
 WHERE {_SEG} <= {radius}e0)"""


POINT = ["event_id", "mmsi", "observed_at"]


def _shapes(t):
    """One GeoJSON geometry per part row, going through all six types."""
    k = F.col("p_partkey") % 6
    x, y = (F.col("p_partkey") % 300) / 10.0, 50.0 + F.col("p_size") / 10.0
    pt = lambda dx, dy: F.concat(F.lit("["), (x + dx).cast("string"), F.lit(","), (y + dy).cast("string"), F.lit("]"))
    path = F.concat(F.lit("["), pt(0.0, 0.0), F.lit(","), pt(0.5, 0.25), F.lit(","), pt(1.0, 0.0), F.lit("]"))
    ring = F.concat(F.lit("["), pt(0.0, 0.0), F.lit(","), pt(1.0, 0.0), F.lit(","), pt(1.0, 1.0), F.lit(","), pt(0.0, 0.0), F.lit("]"))
    coords = (F.when(k == 0, pt(0.0, 0.0)).when(k.isin(1, 2), path).when(k == 3, F.concat(F.lit("["), path, F.lit("]")))
              .when(k == 4, F.concat(F.lit("["), ring, F.lit("]"))).otherwise(F.concat(F.lit("[["), ring, F.lit("]]"))))
    kind = F.element_at(F.array(*[F.lit(n) for n in ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon")]),
                        (k + 1).cast("int"))
    text = F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}"))
    return t.table("part").select(F.col("p_partkey").alias("feature_id"), "p_size", text.alias("geometry"))


_XY = "(p_partkey % 300) / 1e1 AS x, 5e1 + p_size / 1e1 AS y, p_partkey % 6 AS k"
_SEGMENTS = f"""WITH f AS (SELECT p_partkey AS feature_id, {_XY} FROM part), s AS (
 SELECT feature_id, 0 AS seq, x AS ax, y AS ay, NULL::DOUBLE AS bx, NULL::DOUBLE AS by_ FROM f WHERE k = 0
 UNION ALL SELECT feature_id, 0, x, y, x + 5e-1, y + 25e-2 FROM f WHERE k IN (1, 2, 3) UNION ALL SELECT feature_id, 1, x + 5e-1, y + 25e-2, x + 1e0, y FROM f WHERE k IN (1, 2, 3)
 UNION ALL SELECT feature_id, 0, x, y, x + 1e0, y FROM f WHERE k IN (4, 5) UNION ALL SELECT feature_id, 1, x + 1e0, y, x + 1e0, y + 1e0 FROM f WHERE k IN (4, 5)
 UNION ALL SELECT feature_id, 2, x + 1e0, y + 1e0, x, y FROM f WHERE k IN (4, 5))
SELECT feature_id, seq, round(ax, 6) AS a_lon, round(ay, 6) AS a_lat, round(bx, 6) AS b_lon, round(by_, 6) AS b_lat FROM s"""


@query("spa01_segments", _SEGMENTS)
def _(t):
    return sp.geometry_segments(_shapes(t)).select("feature_id", "seq", *[F.round(c, 6).alias(c) for c in ("a_lon", "a_lat", "b_lon", "b_lat")])


@query("spa01_segments_from_vertices", _SEGMENTS)
def _(t):
    return sp.segments(sp.vertices(_shapes(t))).select(
        "feature_id", "seq", *[F.round(c, 6).alias(c) for c in ("a_lon", "a_lat", "b_lon", "b_lat")])


@query("spa02_extent", f"""
WITH f AS (SELECT p_partkey AS feature_id, {_XY} FROM part) SELECT feature_id, round(x, 6) AS west, round(y, 6) AS south,
 round(CASE WHEN k = 0 THEN x ELSE x + 1 END, 6) AS east, round(CASE WHEN k = 0 THEN y WHEN k < 4 THEN y + 25e-2 ELSE y + 1 END, 6) AS north FROM f""")
def _(t):
    return sp.extents(sp.vertices(_shapes(t))).select("feature_id", *[F.round(c, 6).alias(c) for c in ("west", "south", "east", "north")])


@query("spa03_feature_distance", f"""
WITH c AS (SELECT *, CAST(user_id % (SELECT count(*) FROM v_infra) AS VARCHAR) AS fid FROM v_contacts)
SELECT c.event_id, i.feature_id, round({_SEG}, 5) AS nm FROM c JOIN v_infra i ON i.feature_id = c.fid""")
def _(t):
    n = t.infra.agg(F.count("*")).scalar()
    rows = t.contacts.select("event_id", (F.col("user_id") % n).cast("string").alias("feature_id"), "longitude", "latitude")
    return sp.feature_distance(rows, t.infra, ["event_id"]).select("event_id", "feature_id", F.round("distance_nm", 5).alias("nm"))


@query("spa04_track_assembly", """
WITH u AS (SELECT mmsi, seen_at AS o, round(latitude, 5) AS la, round(longitude, 5) AS lo, 0 AS src, event_id FROM v_history WHERE seen_at >= TIMESTAMP '2024-01-26'
 UNION ALL SELECT mmsi, observed_at, round(latitude, 5), round(longitude, 5), 1, event_id FROM v_contacts WHERE observed_at >= TIMESTAMP '2024-01-26'),
r AS (SELECT *, row_number() OVER (PARTITION BY mmsi, o, la, lo ORDER BY src, event_id) AS n FROM u)
SELECT mmsi, epoch_us(o) AS us, src, event_id FROM r WHERE n = 1""")
def _(t):
    hist = t.history.select("mmsi", F.col("seen_at").alias("o"), "latitude", "longitude", "event_id", F.lit(0).alias("src"))
    live = t.contacts.select("mmsi", F.col("observed_at").alias("o"), "latitude", "longitude", "event_id", F.lit(1).alias("src"))
    track = px.assemble_tracks(hist, live, "mmsi", "o", F.lit("2024-01-26").cast("timestamp"), "event_id")
    return track.select("mmsi", F.unix_micros("o").alias("us"), "src", "event_id")


def _rings(t):
    """Square polygons around the suppliers' base places, with a square hole."""
    i = t.infra.select("feature_id", F.col("a_lon").alias("x"), F.col("a_lat").alias("y"))
    def ring(part, dx, dy, w, h):
        c = [(dx, dy), (dx + w, dy), (dx + w, dy + h), (dx, dy + h), (dx, dy)]
        return [F.struct(F.lit(part).alias("part"), (F.col("x") + a[0]).alias("a_lon"), (F.col("y") + a[1]).alias("a_lat"),
                         (F.col("x") + b[0]).alias("b_lon"), (F.col("y") + b[1]).alias("b_lat")) for a, b in zip(c, c[1:])]
    edges = ring(0, 0.0111, 0.0007, 0.1, 0.07) + ring(1, 0.0413, 0.0207, 0.02, 0.02)
    return i.select("feature_id", F.explode(F.array(*edges)).alias("e")).select("feature_id", "e.*")


@query("spa05_point_in_polygon", """
SELECT c.event_id, i.feature_id FROM v_contacts c JOIN v_infra i ON c.longitude > i.a_lon + 111e-4 AND c.longitude < i.a_lon + 1111e-4 AND c.latitude > i.a_lat + 7e-4 AND c.latitude < i.a_lat + 707e-4
WHERE NOT (c.longitude > i.a_lon + 413e-4 AND c.longitude < i.a_lon + 613e-4 AND c.latitude > i.a_lat + 207e-4 AND c.latitude < i.a_lat + 407e-4)""")
def _(t):
    return sp.inside_polygon(t.contacts.select("event_id", "longitude", "latitude"), _rings(t), ["event_id"], 0.05)


@query("jn11_grid_candidates", f"WITH {pairs_sql(2)} SELECT event_id, feature_id, round(d, 5) AS nm FROM pr")
def _(t):
    return near_pairs(t.contacts, t.infra, 2.0, 0.1, ["event_id"], [], places=5).select("event_id", "feature_id", F.col("distance_nm").alias("nm"))


@query("jn12_nearest_feature", f"""
WITH {pairs_sql(2)} SELECT event_id, arg_min(feature_id, (round(d, 9), feature_id)) AS feature_id, round(min(d), 5) AS nm FROM pr GROUP BY 1""")
def _(t):
    return sp.nearest_feature(t.contacts, t.infra, 2.0, 0.1, "event_id").select("event_id", "feature_id", F.round("distance_nm", 5).alias("nm"))


@query("jn12_infrastructure_context", f"""
WITH far AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN -latitude ELSE latitude END AS latitude, CASE WHEN event_id % 3 = 0 THEN longitude - 9e1 ELSE longitude END AS longitude FROM v_contacts),
pr AS (SELECT c.event_id, i.feature_id, i.infrastructure_type, CASE WHEN i.feature_id LIKE '%7' THEN i.feature_id ELSE i.s_name END AS name, {_SEG} AS d FROM far c JOIN v_infra i ON true)
SELECT event_id, arg_min(feature_id, (round(d, 9), feature_id)) AS nearest_reference_id, arg_min(infrastructure_type, (round(d, 9), feature_id)) AS nearest_type,
 arg_min(name, (round(d, 9), feature_id)) AS nearest_name, round(min(d), 4) AS nearest_distance_nm, min(d) <= 5e0 AS found_within_search_radius, min(d) <= 75e-2 AS near_infrastructure_reference
FROM pr GROUP BY 1""")
def _(t):
    # Some points lie near features, others at the other end of the world.
    points = t.contacts.select("event_id", F.when(F.col("event_id") % 5 == 0, -F.col("latitude")).otherwise(F.col("latitude")).alias("latitude"),
                               F.when(F.col("event_id") % 3 == 0, F.col("longitude") - 90.0).otherwise(F.col("longitude")).alias("longitude"))
    infra = t.infra.withColumn("name", F.when(~F.col("feature_id").endswith("7"), F.col("s_name")))
    return sp.infrastructure_context(points, infra, "event_id", 5.0, 0.75).withColumn("nearest_distance_nm", F.round("nearest_distance_nm", 4))


@query("jn13_track_feature_candidates", f"WITH {pairs_sql(2)} SELECT DISTINCT mmsi, feature_id FROM pr")
def _(t):
    return px.track_candidates(t.contacts, t.infra, "mmsi", PARAMS)


# Whole-track evaluation, as the rule reads: every candidate feature against every track point.
EVAL = f"""{pairs_sql(2)}, cd AS (SELECT DISTINCT mmsi, feature_id FROM pr),
ev AS (SELECT c.mmsi, i.feature_id, i.infrastructure_type, c.event_id, c.observed_at, c.sog, c.timestamp_valid, c.latitude, c.longitude, {_SEG} AS d
 FROM cd JOIN v_contacts c USING (mmsi) JOIN v_infra i ON i.feature_id = cd.feature_id),
fl AS (SELECT *, d <= 75e-2 AS near, lag(d <= 75e-2) OVER w AS pnear, epoch_us(observed_at) - lag(epoch_us(observed_at)) OVER w AS gap FROM ev
 WINDOW w AS (PARTITION BY mmsi, feature_id ORDER BY observed_at, event_id)),"""


def dwell_sql(gap_minutes: int) -> str:
    return EVAL + f"""sg AS (SELECT *, sum(CASE WHEN near AND (NOT coalesce(pnear, false) OR gap > {gap_minutes} * 60000000::BIGINT) THEN 1 ELSE 0 END) OVER (PARTITION BY mmsi, feature_id
 ORDER BY observed_at, event_id) AS seg FROM fl),
ds AS (SELECT mmsi, feature_id, max(span) AS dwell FROM (SELECT mmsi, feature_id, seg, (epoch_us(max(observed_at)) - epoch_us(min(observed_at))) / 6e7 AS span FROM sg WHERE near GROUP BY ALL) GROUP BY ALL),
sm AS (SELECT mmsi, feature_id, any_value(infrastructure_type) AS infrastructure_type, count(*) FILTER (near) AS near_points, count(*) FILTER (near AND sog <= 3) AS low_speed_points,
 count(*) FILTER (near AND NOT coalesce(pnear, false)) AS entries, min(d) AS dmin, count(*) FILTER (near AND timestamp_valid) AS valid_points, count(*) AS track_points FROM fl GROUP BY ALL HAVING count(*) FILTER (near) > 0),
su AS (SELECT sm.*, ds.dwell, (low_speed_points >= 2)::INT + (dwell >= 30)::INT + (entries >= 2)::INT AS n_signals FROM sm JOIN ds USING (mmsi, feature_id)),
lv AS (SELECT *, CASE WHEN dmin <= 25e-2 OR (dmin <= 75e-2 AND n_signals >= 2) THEN 'elevated' ELSE 'review' END AS level, CASE WHEN near_points >= 3 AND valid_points / near_points >= 67e-2
 THEN 'medium' ELSE 'low_medium' END AS confidence FROM su),
evt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY CASE WHEN level = 'elevated' THEN 0 ELSE 1 END, dmin, feature_id) AS event_rank FROM lv WHERE n_signals > 0))"""


def summary(t, params=PARAMS):
    numbered = px.number_points(t.contacts, "mmsi", "observed_at", "event_id", params)
    return px.summarise_features(numbered, t.infra, "mmsi", "observed_at", params)


def events(t, params=PARAMS):
    return px.proximity_events(t.contacts, t.infra, "mmsi", "observed_at", "event_id", params)


@query("win05_entries", f"WITH {dwell_sql(180)} SELECT mmsi, feature_id, entries FROM sm")
def _(t):
    return summary(t).select("mmsi", "feature_id", "entries")


@query("win06_longest_dwell", f"WITH {dwell_sql(180)} SELECT mmsi, feature_id, round(dwell, 4) AS dwell FROM ds")
def _(t):
    return summary(t, P.ProximityParams()).select("mmsi", "feature_id", F.round("dwell_minutes", 4).alias("dwell"))


@query("win06_longest_dwell_wide", f"WITH {dwell_sql(2880)} SELECT mmsi, feature_id, round(dwell, 4) AS dwell FROM ds")
def _(t):
    return summary(t).select("mmsi", "feature_id", F.round("dwell_minutes", 4).alias("dwell"))


@query("agg16_proximity_summary", f"""
WITH {dwell_sql(2880)} SELECT mmsi, feature_id, infrastructure_type, near_points, low_speed_points, entries, round(dwell, 4) AS dwell, round(dmin, 5) AS dmin, valid_points, n_signals,
 1 + n_signals + (CAST(mmsi AS BIGINT) % 2 = 0)::INT + (valid_points < near_points)::INT AS n_context FROM su""")
def _(t):
    listed = F.col("mmsi").cast("bigint") % 2 == 0
    vessels = t.contacts.select("mmsi", F.when(listed, F.array(F.lit("watchlist"))).otherwise(F.array(F.lit("other"))).alias("categories")).distinct()
    return px.with_context(summary(t), vessels, "mmsi").withColumn("n_context", F.size("context_signals")).select(
        "n_context", "mmsi", "feature_id", "infrastructure_type", "near_points", "low_speed_points", "entries",
                             F.round("dwell_minutes", 4).alias("dwell"), F.round("minimum_distance_nm", 5).alias("dmin"),
                             F.col("valid_time_points").alias("valid_points"), F.size("signals").alias("n_signals"))


@query("cls08_level_confidence", f"WITH {dwell_sql(2880)} SELECT mmsi, feature_id, level, confidence FROM lv")
def _(t):
    return summary(t).select("mmsi", "feature_id", "level", "confidence")


@query("win07_events_per_vessel", f"""
WITH {dwell_sql(2880)}, la AS (SELECT mmsi, arg_max(longitude, (observed_at, event_id)) AS longitude, arg_max(latitude, (observed_at, event_id)) AS latitude FROM v_contacts GROUP BY 1)
SELECT evt.mmsi, evt.feature_id, event_rank, level, round({_SEG.replace('c.longitude', 'la.longitude').replace('c.latitude', 'la.latitude')}, 4) AS latest_nm, track_points
FROM evt JOIN la USING (mmsi) JOIN v_infra i ON i.feature_id = evt.feature_id""")
def _(t):
    return events(t).select("mmsi", "feature_id", F.col("event_rank").cast("bigint").alias("event_rank"), "level",
                            F.round("latest_distance_nm", 4).alias("latest_nm"), "track_points")


@query("agg19_event_summary", f"""
WITH {dwell_sql(2880)} SELECT count(*) AS event_count, count(*) FILTER (level = 'elevated') AS elevated_count, count(*) FILTER (level = 'review') AS review_count,
 least(5, count(*) FILTER (level = 'elevated') * 2 + least(2, count(*) FILTER (level = 'review'))) AS suggested_delta FROM evt""")
def _(t):
    return px.event_summary(events(t))


@query("ord04_event_order", f"WITH {dwell_sql(2880)} SELECT mmsi, feature_id, level FROM evt ORDER BY level <> 'elevated', dmin")
def _(t):
    return px.order_events(events(t)).select("mmsi", "feature_id", "level")


