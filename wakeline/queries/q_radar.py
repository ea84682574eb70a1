"""Radar detections against tracks, and gridded presence."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.operators import matching, radar, review
from wakeline.queries import fragments as S
from wakeline.queries.q_snapshot import PROJECTED, projected
from wakeline.queries.registry import query

_DIST = S.haversine_m("d.longitude", "d.latitude", "p.plon", "p.plat")
PAIRS = f"""{PROJECTED}, raw AS (SELECT d.detection_id, p.mmsi, {_DIST} AS m, p.quality, least(2000e0, greatest(5e2, 5e2 + least(75e1, motion * 1e-1)
 + CASE method WHEN 'SOG_COG_EXTRAPOLATION_SINGLE_SIDED' THEN 25e1 WHEN 'NEAREST_OBSERVATION_NO_MOTION_MODEL' THEN 5e2 ELSE 0 END
 + least(1e2, sqrt(span_x_m * span_x_m + span_y_m * span_y_m) / 2e0))) AS radius
 FROM v_detections d JOIN prj p ON abs(d.latitude - p.plat) < 4e-2 AND abs(d.longitude - p.plon) < 1e-1),
pairs AS (SELECT *, round(m, 1) AS distance_m, m <= radius AS inside FROM raw WHERE m <= 2000)"""
STATES = PAIRS + """, pd AS (SELECT detection_id, count(*) AS v FROM pairs GROUP BY 1), pv AS (SELECT mmsi, count(DISTINCT detection_id) AS r FROM pairs GROUP BY 1),
best AS (SELECT pairs.*, v, r, row_number() OVER (PARTITION BY detection_id ORDER BY distance_m, pairs.mmsi) AS k, max(r) OVER (PARTITION BY detection_id) AS rivals
 FROM pairs JOIN pd USING (detection_id) JOIN pv ON pv.mmsi = pairs.mmsi),
st AS (SELECT d.detection_id, coalesce(v, 0) AS alternatives, CASE WHEN v IS NULL THEN 'UNMATCHED_IN_AVAILABLE_AIS' WHEN v > 1 OR rivals > 1 THEN 'AMBIGUOUS'
 WHEN inside AND quality IN ('HIGH', 'MEDIUM') THEN 'MATCHED' ELSE 'POSSIBLE_MATCH' END AS match_state, b.mmsi, b.distance_m FROM v_detections d LEFT JOIN best b ON b.detection_id = d.detection_id AND k = 1)"""


def pairs(t):
    return radar.candidate_pairs(t.detections, projected(t))


@query("spa07_dynamic_radius", f"WITH {PAIRS} SELECT detection_id, mmsi, round(radius, 2) AS radius FROM pairs")
def _(t):
    return pairs(t).select("detection_id", "mmsi", F.col("dynamic_radius_m").alias("radius"))


@query("jn15_detection_track_pairs", f"WITH {PAIRS} SELECT detection_id, mmsi, distance_m, inside FROM pairs")
def _(t):
    return pairs(t).select("detection_id", "mmsi", "distance_m", F.col("within_dynamic_radius").alias("inside"))


@query("jn16_competition", f"""
WITH {PAIRS} SELECT detection_id, mmsi, count(*) OVER (PARTITION BY detection_id) AS vessels, count(*) OVER (PARTITION BY mmsi) AS detections FROM pairs""")
def _(t):
    return radar.competition(pairs(t)).select("detection_id", "mmsi", "vessels", "detections")


@query("cls07_match_state", f"""
WITH {STATES} SELECT detection_id, match_state, alternatives, CASE WHEN match_state IN ('MATCHED', 'POSSIBLE_MATCH') THEN mmsi END AS selected_mmsi FROM st""")
def _(t):
    enough = t.spark.range(1).select(F.lit(True).alias("sufficient"))
    return radar.match_states(t.detections, pairs(t), enough).select("detection_id", "match_state", "alternatives", "selected_mmsi")


@query("cls07_no_coverage", f"""
WITH {STATES} SELECT detection_id, CASE match_state WHEN 'UNMATCHED_IN_AVAILABLE_AIS' THEN 'NO_AIS_COVERAGE' WHEN 'MATCHED' THEN 'POSSIBLE_MATCH' ELSE match_state END AS match_state, alternatives FROM st""")
def _(t):
    # Nothing was heard around the scene, so the coverage summary itself says that it does not suffice.
    silence = t.contacts.where("observed_at < TIMESTAMP '2000-01-01'")
    enough = radar.coverage_summary(silence, F.lit("2024-01-15").cast("timestamp"), 144, "observed_at", P.MatchParams())
    return radar.match_states(t.detections, pairs(t), enough.select("sufficient")).select("detection_id", "match_state", "alternatives")


@query("agg13_match_state_counts", f"""
WITH {STATES} SELECT label, count(match_state) AS n FROM (SELECT unnest([{S.quoted(P.MATCH_STATES)}]) AS label) LEFT JOIN st ON match_state = label GROUP BY 1""")
def _(t):
    enough = t.spark.range(1).select(F.lit(True).alias("sufficient"))
    return radar.label_counts(radar.match_states(t.detections, pairs(t), enough), "match_state", P.MATCH_STATES)


@query("ord05_evidence", f"""
WITH {PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY detection_id ORDER BY distance_m, mmsi) AS n, count(*) OVER (PARTITION BY detection_id) AS c FROM pairs)
SELECT detection_id, mmsi, n AS evidence_rank, c AS alternatives, n <= 2 AS within_limit FROM r""")
def _(t):
    out = radar.evidence(pairs(t), P.MatchParams(evidence_limit=2))
    return out.select("detection_id", "mmsi", F.col("evidence_rank").cast("bigint").alias("evidence_rank"), "alternatives", "within_limit")


@query("jn21_projection_consistency", f"""
WITH {PROJECTED} SELECT count(*) AS compared, count(*) FILTER ({S.haversine_m('plon', 'plat', "plon + CASE WHEN quality = 'LOW' THEN 1e-3 ELSE 0 END", 'plat')} > 2) AS inconsistent FROM prj""")
def _(t):
    p = projected(t)
    a = p.select("mmsi", F.col("projected_longitude").alias("longitude"), F.col("projected_latitude").alias("latitude"))
    b = p.select("mmsi", (F.col("projected_longitude") + F.when(F.col("projection_quality") == "LOW", 1e-3).otherwise(0.0)).alias("longitude"),
                 F.col("projected_latitude").alias("latitude"))
    return review.projection_consistency(a, b)


# --- gridded ---------------------------------------------------------------------------

_KEY = "region_id, ais_matched, observed_at, la, lo, vessel_id, imo, mmsi"
GRID = f"""g0 AS (SELECT *, round(latitude, 5) AS la, round(longitude, 5) AS lo, latitude <= 90 AND observed_at IS NOT NULL AS ok FROM v_grid),
gr AS (SELECT DISTINCT {_KEY} FROM g0 WHERE ok)"""


@query("set07_grid_dedup", f"""
WITH {GRID} SELECT (SELECT count(*) FROM g0) AS rows_seen, (SELECT count(*) FROM g0 WHERE NOT ok) AS rows_invalid, (SELECT count(*) FROM g0 WHERE ok) - count(*) AS duplicates FROM gr""")
def _(t):
    return radar.grid_dedup_counts(t.grid)


_RECORD = ("id", "region_id", "ais_matched", "observed_at", "latitude", "longitude", "vessel_id", "imo", "mmsi", "watchlist_match")


def records(t):
    return radar.grid_records(matching.watch_match_basis(t.grid, t.watchlist), "sar_").select(*_RECORD)


def ais_side(grid):
    rows = grid.where("NOT ais_matched AND vessel_id IS NOT NULL").withColumn("ais_matched", F.lit(False))
    return radar.grid_records(rows, "aisctx_", ("region_id", "vessel_id", "observed_at", "lat5", "lon5"), together="vessel_id")


_W = f"""wi AS (SELECT DISTINCT {S.digits('imo')} AS id FROM v_watchlist WHERE length({S.digits('imo')}) = 7), wm AS (SELECT DISTINCT {S.digits('mmsi')} AS id FROM v_watchlist
 WHERE length({S.digits('mmsi')}) = 9), rec AS (SELECT gr.*, 'sar_' || substr(sha1(region_id || '|' || ais_matched || '|' || strftime(observed_at, '%Y-%m-%d %H:%M:%S') || '|' || la || '|' || lo
 || '|' || coalesce(vessel_id, '') || '|' || imo || '|' || mmsi), 1, 18) AS id, wi.id IS NOT NULL OR wm.id IS NOT NULL AS watch FROM gr
 LEFT JOIN wi ON wi.id = {S.digits('gr.imo')} LEFT JOIN wm ON wm.id = {S.digits('gr.mmsi')})"""


@query("ord02_priority_cap", f"""
WITH {GRID}, {_W} SELECT id, watch AS watchlist_match, ais_matched, row_number() OVER (ORDER BY watch DESC, ais_matched, observed_at DESC, id) AS priority_rank FROM rec""")
def _(t):
    return radar.prioritised(records(t)).select("id", "watchlist_match", "ais_matched", "priority_rank")


_SEL = f"""pv AS (SELECT vessel_id, max(observed_at) AS newest, arg_max(watch, (observed_at, watch)) AS prot FROM rec WHERE ais_matched AND vessel_id IS NOT NULL GROUP BY 1),
sel AS (SELECT vessel_id FROM pv)"""


@query("ord03_protected_cap", f"WITH {GRID}, {_W}, {_SEL} SELECT vessel_id FROM sel")
def _(t):
    return radar.select_context_ids(records(t)).select("vessel_id")


@query("jn17_selected_semi", f"""
WITH {GRID}, {_W}, {_SEL} SELECT region_id, count(DISTINCT vessel_id) AS vessels FROM rec WHERE vessel_id IN (SELECT vessel_id FROM sel) GROUP BY 1""")
def _(t):
    r = records(t)
    ids = radar.select_context_ids(r).select("vessel_id")
    return r.join(ids, "vessel_id", "left_semi").groupBy("region_id").agg(F.count_distinct("vessel_id").alias("vessels"))


LIMIT_MIN = 1440 * 20
CORR = f"""{GRID}, {_W}, {_SEL}, ax AS (SELECT DISTINCT region_id, vessel_id, observed_at, la, lo FROM gr WHERE NOT ais_matched AND vessel_id IS NOT NULL),
rr AS (SELECT rec.*, rec.vessel_id IN (SELECT vessel_id FROM sel) AS chosen, EXISTS (SELECT 1 FROM ax WHERE ax.region_id = rec.region_id AND ax.vessel_id = rec.vessel_id) AS here
 FROM rec WHERE ais_matched),
cand AS (SELECT rr.id, abs(epoch_us(ax.observed_at) - epoch_us(rr.observed_at)) / 6e7 AS delta, {S.haversine_nm('rr.lo', 'rr.la', 'ax.lo', 'ax.la')} AS nm
 FROM rr JOIN ax ON ax.vessel_id = rr.vessel_id AND (NOT here OR ax.region_id = rr.region_id) WHERE chosen),
bst AS (SELECT id, min((delta, round(nm, 6))) AS b FROM cand WHERE delta <= {LIMIT_MIN} GROUP BY 1),
cor AS (SELECT rec.id, CASE WHEN NOT ais_matched THEN 'not_applicable_ais_unmatched' WHEN vessel_id IS NULL OR vessel_id NOT IN (SELECT vessel_id FROM sel) THEN 'not_requested_identity_cap'
 WHEN bst.id IS NOT NULL THEN 'time_aligned_same_identity' ELSE 'requested_but_no_time_aligned_context' END AS status, round(b[1], 1) AS delta, round(b[2], 2) AS nm FROM rec LEFT JOIN bst USING (id))"""


def correlated(t):
    grid = radar.in_chunks(t.grid)
    rows = matching.watch_match_basis(grid, t.watchlist)
    r = radar.grid_records(rows, "sar_", together="vessel_id")
    r = r.select(*_RECORD, *[c for c in (radar.DEAL, radar.PART) if c in r.columns])
    # A vessel's newest row is the same with its repeats, so they are not removed for that a second time.
    return radar.correlate(r, ais_side(grid), radar.select_context_ids(radar.valid_grid(rows)), LIMIT_MIN)


@query("jn14_time_aligned", f"WITH {CORR} SELECT id, delta, nm FROM cor WHERE status = 'time_aligned_same_identity'")
def _(t):
    return correlated(t).where("ais_context_id IS NOT NULL").select("id", F.col("time_delta_minutes").alias("delta"), F.col("distance_nm").alias("nm"))


@query("cls11_correlation_status", f"WITH {CORR} SELECT id, status FROM cor")
def _(t):
    return correlated(t).select("id", F.col("correlation_status").alias("status"))


@query("agg20_correlation_summary", f"""
WITH {CORR} SELECT count(*) AS sar_records, count(*) FILTER (status = 'not_applicable_ais_unmatched') AS ais_unmatched_sar, count(*) FILTER (status = 'not_requested_identity_cap')
 AS matched_identity_not_selected, count(*) FILTER (status IN ('time_aligned_same_identity', 'requested_but_no_time_aligned_context')) AS matched_identity_selected,
 count(*) FILTER (status = 'time_aligned_same_identity') AS time_aligned_correlations, count(*) FILTER (status = 'requested_but_no_time_aligned_context') AS selected_without_time_aligned_context FROM cor""")
def _(t):
    return radar.correlation_summary(correlated(t))


# --- review objects ---------------------------------------------------------------------

_SEP = S.haversine_m("r.longitude", "r.latitude", "s.longitude", "s.latitude")
_CL = S.haversine_m("r.longitude", "r.latitude", "r.projected_longitude", "r.projected_latitude")
_AL = f"abs({S.fmod('(' + S.bearing('r.longitude', 'r.latitude', 's.longitude', 's.latitude') + ') - r.effective_cog + 18e1', '36e1')} - 18e1)"
CHECKED = f"""fr AS (SELECT r.object_id, {_SEP} AS sep, {_AL} AS al, {_CL} AS cl, r.mmsi = s.mmsi AS same_mmsi, r.length_m AS len, r.within_dynamic_radius AND s.within_dynamic_radius AS all_in
 FROM v_members r JOIN v_members s ON r.object_id = s.object_id WHERE r.is_representative AND NOT s.is_representative),
ck AS (SELECT *, sep / len BETWEEN 5e-1 AND 125e-2 AS length_ok, al <= 15 AS aligned, cl <= 50 AS close FROM fr)"""
LABELS = """lb AS (SELECT object_id, count(*) AS member_count, CASE WHEN max(profile_count) >= 3 AND bool_or(vh_corroborated) THEN 'HIGH' WHEN max(profile_count) >= 2 THEN 'MEDIUM' ELSE 'LOW' END AS detection_quality,
 CASE WHEN bool_and(coverage_ok) AND bool_and(bins_complete) AND max(gap_seconds) <= 60 AND bool_and(projection_quality = 'HIGH') THEN 'HIGH'
 WHEN bool_and(coverage_ok) AND bool_and(projection_quality IN ('HIGH', 'MEDIUM')) THEN 'MEDIUM' ELSE 'LOW' END AS data_quality FROM v_members GROUP BY 1)"""
OBJECTS = CHECKED + ", " + LABELS + """, ob AS (SELECT lb.*, string_agg(m.detection_id, ',' ORDER BY m.detection_id) AS detection_ids, bool_and(m.distance_m <= 2000) AS plausible, min(m.mmsi) = max(m.mmsi) AS same
 FROM lb JOIN v_members m USING (object_id) GROUP BY ALL),
oj AS (SELECT ob.object_id, CASE WHEN member_count = 2 THEN 'COURSE_AND_LENGTH_ALIGNED_FRAGMENT_CLUSTER' ELSE 'SINGLE_CANDIDATE' END AS grouping_method, member_count, ob.detection_ids, detection_quality, data_quality,
 CASE WHEN member_count = 2 THEN CASE WHEN same AND plausible AND coalesce(same_mmsi AND length_ok AND aligned AND close AND all_in, false) THEN 'HIGH' WHEN same AND plausible THEN 'MEDIUM' ELSE 'LOW' END
 ELSE CASE WHEN l.match_state = 'MATCHED' AND l.within_dynamic_radius AND l.projection_quality IN ('HIGH', 'MEDIUM') THEN 'HIGH' WHEN l.match_state = 'POSSIBLE_MATCH' AND l.projection_quality IN ('HIGH', 'MEDIUM')
  AND l.distance_m <= 2000 AND l.span_m / l.length_m BETWEEN 5e-1 AND 2e0 THEN 'MEDIUM' WHEN l.distance_m <= 2000 THEN 'LOW' ELSE 'NOT_ASSESSABLE' END END AS match_quality
 FROM ob LEFT JOIN ck USING (object_id) LEFT JOIN v_members l ON l.object_id = ob.object_id AND l.is_representative)"""


@query("agg21_quality_labels", f"WITH {LABELS} SELECT * FROM lb")
def _(t):
    return review.quality_labels(t.members)


@query("agg22_fragment_checks", f"""
WITH {CHECKED} SELECT object_id, round(sep, 1) AS separation_m, round(al, 2) AS alignment_deg, same_mmsi, length_ok, aligned, close, all_in AS all_in_radius,
 same_mmsi AND length_ok AND aligned AND close AND all_in AS all_passed FROM ck""")
def _(t):
    return review.fragment_checks(t.members).drop("representative_distance_m")


@query("cls10_review_objects", f"WITH {OBJECTS} SELECT object_id, grouping_method, member_count, detection_ids, detection_quality, data_quality, match_quality FROM oj")
def _(t):
    return review.assemble_objects(t.members).withColumn("detection_ids", F.array_join("detection_ids", ",")).drop("mmsi")


@query("agg23_queue_summary", f"""
WITH {OBJECTS} SELECT sum(member_count)::BIGINT AS source_candidates, count(*) AS review_objects, count(*) FILTER (member_count = 2) AS fragment_clusters, count(*) FILTER (member_count = 1) AS single_candidates,
 {', '.join(f"count(*) FILTER ({d}_quality = '{q}') AS {d}_{q.lower()}" for d in ('detection', 'data', 'match') for q in ('HIGH', 'MEDIUM', 'LOW'))},
 sum(member_count)::BIGINT - count(*) AS reduction FROM oj""")
def _(t):
    return review.queue_summary(review.assemble_objects(t.members))


@query("set05_preserved_once", """
SELECT detection_id, n AS listed FROM (SELECT detection_id, 2 AS n FROM v_members WHERE distance_m < 2e2 UNION ALL SELECT detection_id, NULL FROM v_members WHERE distance_m > 2e3)""")
def _(t):
    # Objects that lost the far members and list the near ones twice: exactly those must be reported.
    m = t.members
    objects = m.where("distance_m <= 2000").groupBy("object_id").agg(F.collect_list("detection_id").alias("detection_ids"))
    twice = m.where("distance_m < 200").groupBy("object_id").agg(F.collect_list("detection_id").alias("detection_ids"))
    return review.preserved_once(m, objects.unionByName(twice)).select("detection_id", F.col("listed").cast("int").alias("listed"))


