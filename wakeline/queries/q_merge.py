"""Entity merge, latest positions, audits and ordering."""

from pyspark.sql import functions as F

from wakeline.functions import identity
from wakeline.functions.text import norm_digits
from wakeline.operators import archive, audit, history, merge
from wakeline.operators import reference as ref
from wakeline.operators.filters import archive_reject_reason, reject_counts
from wakeline.operators.keyed import top_k
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import AS_OF
from wakeline.queries.q_filters import REJECT
from wakeline.queries.registry import query

FIELDS = ("imo", "callsign", "name", "destination", "latitude", "longitude")


def _newest(order: str, extra: str = "") -> str:
    picks = ", ".join(f"arg_max({f}, {order}) FILTER ({S.present(f)} IS NOT NULL) AS {f}" for f in FIELDS[:4])
    return f"{picks}, round(arg_max(latitude, {order}), 6) AS latitude, round(arg_max(longitude, {order}), 6) AS longitude{extra}"


@query("agg01_newest_nonempty", f"""
WITH o AS (SELECT *, {S.ID_MERGE} AS id, CASE provider WHEN 'aisstream' THEN 0 WHEN 'fintraffic' THEN 1 ELSE 2 END AS po FROM v_contacts)
SELECT id, {_newest('(observed_at, po, event_id)')}, string_agg(DISTINCT provider, ',' ORDER BY provider) AS sources, count(*) AS merged_rows FROM o GROUP BY 1""")
def _(t):
    rank = F.when(F.col("provider") == "aisstream", 0).when(F.col("provider") == "fintraffic", 1).otherwise(2)
    rows = t.contacts.withColumns({"id": identity.id_merge(), "po": rank})
    out = merge.newest_nonempty(rows, "id", FIELDS, ("observed_at", "po", "event_id"), sources="provider")
    return out.withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6),
                            "sources": F.array_join("sources", ",")})


@query("agg02_last_nonempty", f"""
WITH o AS (SELECT *, {S.digits('mmsi')} AS id FROM v_contacts) SELECT id, {_newest('event_id')}, count(*) AS merged_rows FROM o GROUP BY 1""")
def _(t):
    out = merge.newest_nonempty(t.contacts.withColumn("id", norm_digits("mmsi")), "id", FIELDS, ("event_id",))
    return out.withColumns({"latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})


_TYPED = f"""ar AS (SELECT *, {REJECT} AS reason FROM v_archive),
ty AS (SELECT event_id, mmsi, strptime(timestamp, '%d/%m/%Y %H:%M:%S') AS observed_at, round(CAST(latitude AS DOUBLE), 6) AS latitude,
 round(CAST(longitude AS DOUBLE), 6) AS longitude, CASE WHEN length({S.digits('imo')}) = 7 THEN {S.digits('imo')} END AS imo,
 nullif(callsign, 'Unknown') AS callsign, {S.present('name')} AS name, nullif(destination, 'Unknown') AS destination, ship_type,
 CASE WHEN CAST(sog AS DOUBLE) < 102.2 THEN CAST(sog AS DOUBLE) END AS sog, CASE WHEN CAST(cog AS DOUBLE) < 360 THEN CAST(cog AS DOUBLE) END AS cog,
 CASE WHEN CAST(heading AS INT) < 511 THEN CAST(heading AS INT) END AS th, {S.present('width')} AS width FROM ar WHERE reason IS NULL),
sc AS (SELECT *, (imo IS NOT NULL)::INT + (callsign IS NOT NULL)::INT + (name IS NOT NULL)::INT + 1 + (width IS NOT NULL)::INT + 1 + (destination IS NOT NULL)::INT
 + (sog IS NOT NULL)::INT + (cog IS NOT NULL)::INT + (th IS NOT NULL)::INT AS score FROM ty)"""
_TOP2 = _TYPED + """, one AS (SELECT *, row_number() OVER (PARTITION BY mmsi, observed_at ORDER BY score DESC, event_id) AS r1 FROM sc),
two AS (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY observed_at DESC) AS rank FROM one WHERE r1 = 1)"""


def typed(t):
    return archive.typed_records(t.archive, "event_id", F.col("column_count"))


@query("win01_latest_two", f"""
WITH {_TOP2} SELECT mmsi, rank, event_id, epoch(observed_at)::BIGINT AS sec, latitude, longitude FROM two WHERE rank <= 2""")
def _(t):
    return merge.latest_two(typed(t), "mmsi", "observed_at", "event_id").select(
        "mmsi", F.col("rank").cast("bigint").alias("rank"), "event_id", F.unix_seconds("observed_at").alias("sec"), "latitude", "longitude")


@query("agg10_reject_counters", f"""
SELECT coalesce({REJECT}, 'kept') AS reason, count(*) AS n FROM v_archive GROUP BY 1""")
def _(t):
    return reject_counts(t.archive, archive_reject_reason(F.col("column_count")))


@query("agg10_position_counters", f"""
WITH {_TYPED}, t AS (SELECT mmsi, observed_at, count(*) AS n, count(DISTINCT (latitude, longitude)) AS p FROM sc GROUP BY ALL),
k AS (SELECT mmsi, sum(n - p) AS d, sum(p - 1) AS c, greatest(0, count(*) - 2) AS o FROM t GROUP BY 1)
SELECT sum(d)::BIGINT AS duplicate_same_time_position, sum(c)::BIGINT AS conflicting_positions_same_timestamp, sum(o)::BIGINT AS older_positions_discarded FROM k""")
def _(t):
    return merge.duplicate_counters(typed(t), "mmsi", "observed_at", "latitude", "longitude")


@query("agg27_contact_positions", f"""
WITH {_TOP2}, l AS (SELECT * FROM two WHERE rank = 1), p AS (SELECT * FROM two WHERE rank = 2)
SELECT l.mmsi, coalesce(l.imo, p.imo) AS imo, coalesce(l.callsign, p.callsign) AS callsign, coalesce(l.name, p.name) AS name,
 coalesce(l.destination, p.destination) AS destination, CASE WHEN p.mmsi IS NULL THEN 1 ELSE 2 END AS position_count,
 epoch(l.observed_at)::BIGINT AS latest, epoch(p.observed_at)::BIGINT AS previous FROM l LEFT JOIN p USING (mmsi)""")
def _(t):
    two = merge.latest_two(typed(t), "mmsi", "observed_at", "event_id")
    out = merge.contact_with_positions(two, "mmsi", "observed_at", ("imo", "callsign", "name", "destination"),
                                       ("latitude", "longitude", "sog", "cog"))
    return out.select("mmsi", "imo", "callsign", "name", "destination", "position_count",
                      F.unix_seconds("latest_position.observed_at").alias("latest"),
                      F.unix_seconds("previous_position.observed_at").alias("previous"))


@query("agg28_best_identity", f"""
WITH {_TYPED} SELECT mmsi, arg_max(struct_pack(imo, callsign, name), (score, -event_id)).imo AS imo,
 arg_max(struct_pack(imo, callsign, name), (score, -event_id)).callsign AS callsign, arg_max(struct_pack(imo, callsign, name), (score, -event_id)).name AS name
FROM sc GROUP BY 1""")
def _(t):
    return merge.best_identity(typed(t), "mmsi", ("imo", "callsign", "name"), "event_id")


_GRID_ID = f"coalesce('imo:' || {S.sized('imo', 7)}, 'mmsi:' || {S.sized('mmsi', 9)}, 'gfw:' || vessel_id)"


@query("win02_grid_latest_two", f"""
WITH g AS (SELECT DISTINCT {_GRID_ID} AS id, observed_at, round(latitude, 5) AS la, round(longitude, 5) AS lo FROM v_grid WHERE latitude <= 90 AND observed_at IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, la, lo) AS rank FROM g WHERE id IS NOT NULL)
SELECT id, epoch(observed_at)::BIGINT AS sec, la, lo, rank FROM r WHERE rank <= 2""")
def _(t):
    rows = t.grid.where("latitude <= 90 AND observed_at IS NOT NULL").select(
        identity.id_grid().alias("id"), "observed_at", F.round("latitude", 5).alias("la"), F.round("longitude", 5).alias("lo")
    ).where("id IS NOT NULL").distinct()
    return top_k(rows, ["id"], [F.col("observed_at").desc(), F.col("la"), F.col("lo")], 2, rank="rank").select(
        "id", F.unix_seconds("observed_at").alias("sec"), "la", "lo", F.col("rank").cast("bigint").alias("rank"))


@query("win03_previous_step", f"""
WITH p AS (SELECT *, lag(longitude) OVER w AS plon, lag(latitude) OVER w AS plat FROM v_contacts WINDOW w AS (PARTITION BY mmsi ORDER BY observed_at, event_id))
SELECT event_id, round({S.haversine_nm('plon', 'plat', 'longitude', 'latitude')}, 3) AS step_nm FROM p""")
def _(t):
    return history.previous_step(t.contacts, "mmsi", "observed_at", "event_id").select("event_id", "step_nm")


@query("agg08_watchlist_audit", f"""
WITH k AS (SELECT *, {S.ID_DEDUPE} AS key FROM v_watchlist) SELECT count(*) AS rows, count(DISTINCT key) AS unique_identity_keys,
 count(key) - count(DISTINCT key) AS duplicate_rows, count(*) FILTER (key IS NULL) AS missing_identity_rows,
 count(*) FILTER (regexp_matches(lower(name || ' ' || notes || ' ' || source_list), 'test_only|example|dummy|sample')) AS test_rows,
 count(*) FILTER (track_sanctions) AS track_sanctions_rows, count(*) FILTER (track_shadowfleet) AS track_shadowfleet_rows FROM k""")
def _(t):
    return audit.watchlist_audit(t.watchlist)


@query("agg08_duplicate_lines", f"""
WITH k AS (SELECT line_no, {S.ID_DEDUPE} AS key FROM v_watchlist), f AS (SELECT key, min(line_no) AS first FROM k WHERE key IS NOT NULL GROUP BY 1)
SELECT line_no AS line, first AS duplicates_line, key FROM k JOIN f USING (key) WHERE line_no > first""")
def _(t):
    return audit.duplicate_lines(t.watchlist)


@query("agg09_provider_ranges", """
SELECT provider, count(*) AS n, epoch_us(min(observed_at)) AS first_us, epoch_us(max(observed_at)) AS last_us FROM v_contacts GROUP BY 1""")
def _(t):
    from wakeline.operators.snapshot import provider_ranges

    return provider_ranges(t.contacts, "observed_at").select(
        "provider", "n", F.unix_micros("first_at").alias("first_us"), F.unix_micros("last_at").alias("last_us"))


_PIECES = ", ".join(f"sum(CAST(('0x' || substr(h, {1 + 15 * i}, 15)) AS HUGEINT))::VARCHAR" for i in range(4))


@query("agg12_fingerprint", f"""
WITH h AS (SELECT sha256(concat_ws(chr(31), 'v' || CAST(line_no AS VARCHAR), coalesce('v' || name, 'n'), CASE WHEN mmsi = '' THEN 'n' ELSE 'v' || mmsi END,
 coalesce('v' || callsign, 'n'))) AS h FROM v_watchlist),
s AS (SELECT count(*) AS rows, concat_ws('|', count(*)::VARCHAR, {_PIECES}) AS x FROM h)
SELECT rows, sha256(x) AS fingerprint FROM s""")
def _(t):
    # Missing numbers as NULL: a NULL is no text, and no neighbour takes its place.
    return audit.fingerprint(t.watchlist.withColumn("mmsi", F.nullif("mmsi", F.lit(""))), "line_no", "name", "mmsi", "callsign")


@query("agg24_source_ages", f"""
SELECT string_agg(DISTINCT provider, ',' ORDER BY provider) AS sources, epoch_us(max(observed_at)) AS newest,
 round(epoch_us(TIMESTAMP '{AS_OF}' - max(observed_at)) / 36e8, 2) AS age_hours FROM v_contacts""")
def _(t):
    return audit.source_ages(t.contacts, "provider", "observed_at", t.as_of).withColumn("newest", F.unix_micros("newest"))


@query("agg26_run_health", """
WITH s AS (SELECT provider, count(*) AS n, max(observed_at) < TIMESTAMP '2024-01-30 23:00:00' AS stale FROM v_contacts GROUP BY 1)
SELECT 'ok' AS health, 'mixed_regional_and_primary' AS coverage_mode, bool_or(stale) AS stale,
 count(*) AS included, sum(n)::BIGINT AS matches FROM s""")
def _(t):
    status = t.contacts.groupBy("provider").agg(F.count("*").alias("matches"), F.max("observed_at").alias("m")).select(
        "provider", "matches", F.lit(True).alias("included"), (F.col("m") < F.lit("2024-01-30 23:00:00").cast("timestamp")).alias("stale"),
        F.lit(False).alias("failed"), F.lit(False).alias("capped"))
    return audit.run_health(status)


@query("win07_top_per_vessel", """
WITH r AS (SELECT mmsi, event_id, row_number() OVER (PARTITION BY mmsi ORDER BY sog DESC, event_id) AS n FROM v_contacts)
SELECT mmsi, event_id, n FROM r""")
def _(t):
    return top_k(t.contacts, ["mmsi"], [F.col("sog").desc(), F.col("event_id")], None, rank="n").select(
        "mmsi", "event_id", F.col("n").cast("bigint").alias("n"))


@query("win08_track_points", f"""
WITH d AS (SELECT DISTINCT mmsi, observed_at, latitude, longitude FROM v_contacts WHERE observed_at >= TIMESTAMP '{AS_OF}' - INTERVAL 240 HOUR),
r AS (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY observed_at DESC, latitude DESC, longitude DESC) AS n FROM d),
k AS (SELECT * FROM r), l AS (SELECT mmsi, count(*) AS c FROM k GROUP BY 1)
SELECT mmsi, epoch_us(observed_at) AS us, CASE WHEN n = 1 THEN 'latest_in_window' ELSE 'historical_point' END AS role, NULL::BIGINT AS points FROM k
UNION ALL SELECT mmsi, NULL, 'historical_track', c FROM l WHERE c >= 2""")
def _(t):
    pts = history.track_points(t.contacts, "mmsi", "observed_at", t.as_of - F.expr("INTERVAL 240 HOUR"))
    # The points of a track are counted from the vertices of all its pieces, which share their end points.
    lines = history.track_lines(pts, "mmsi", "observed_at").groupBy("mmsi").agg((F.sum(F.size("path") - 1) + 1).alias("points"))
    return pts.select("mmsi", F.unix_micros("observed_at").alias("us"), F.col("timeline_role").alias("role"),
                      F.lit(None).cast("bigint").alias("points")).unionByName(lines.select(
                          "mmsi", F.lit(None).cast("bigint").alias("us"), F.lit("historical_track").alias("role"),
                          F.col("points")))


@query("ord01_newest_cap", """
SELECT event_id, row_number() OVER (ORDER BY observed_at DESC, event_id) AS newest_rank, true AS within_limit FROM v_contacts""")
def _(t):
    return audit.rank_newest(t.contacts, "observed_at", "event_id").select("event_id", "newest_rank", "within_limit")


_TYPES = "t AS (SELECT p_partkey, lower(p_name) AS n, lower(p_type) AS ti, lower(p_name || ' ' || p_type || ' ' || p_brand) AS x FROM part)"


@query("ord07_feature_types", f"""
WITH {_TYPES}, s AS (SELECT p_partkey, CASE WHEN x LIKE '%brand#13%' THEN -100e0 WHEN x NOT LIKE '%e%' THEN -50e0
 WHEN x NOT LIKE '%red%' AND x NOT LIKE '%economy%' THEN -10e0 ELSE (CASE WHEN x LIKE '%red%' THEN 10e0 ELSE 0 END + CASE WHEN x LIKE '%economy%' THEN 10e0 ELSE 0 END + 5
 + CASE WHEN ti LIKE '%red%' OR ti LIKE '%economy%' THEN 2 ELSE 0 END + CASE WHEN n LIKE '%red%' OR n LIKE '%economy%' THEN 1 ELSE 0 END) END AS score FROM t)
SELECT p_partkey, score FROM s WHERE score > 0 AND score >= greatest(1, (SELECT max(score) FROM s) - 4)""")
def _(t):
    score = ref.type_score(F.col("p_name"), F.col("p_type"), F.col("p_brand"), include_any=("red", "economy"), include_all=("e",),
                           exclude=("brand#13",))
    return ref.choose_types(t.table("part"), score, "p_partkey").select("p_partkey", "score")


@query("set01_first_group_wins", f"""
WITH c AS (SELECT CASE WHEN event_id % 10 > 0 THEN imo END AS imo, CASE WHEN event_id % 10 > 0 THEN mmsi END AS mmsi, CASE WHEN event_id % 10 > 0 THEN callsign END AS callsign,
 CASE WHEN event_id % 10 > 0 THEN name END AS name, round(latitude, 6) AS la, round(longitude, 6) AS lo, event_id FROM v_contacts),
u AS (SELECT {S.ID_DEDUPE} AS k, la, lo, 0 AS g, event_id AS s FROM c UNION ALL SELECT {S.ID_DEDUPE}, NULL, NULL, 1, line_no FROM v_watchlist)
SELECT arg_min(g, (g, s)) AS grp, arg_min(s, (g, s)) AS seq FROM u GROUP BY k, CASE WHEN k IS NULL THEN (la, lo) END""")
def _(t):
    # Every tenth contact has lost its identity: what tells such rows apart is their place.
    known = F.col("event_id") % 10 > 0
    live = t.contacts.select(*[F.when(known, F.col(c)).alias(c) for c in ("imo", "mmsi", "callsign", "name")], F.round("latitude", 6).alias("latitude"),
                             F.round("longitude", 6).alias("longitude"), F.col("event_id").alias("seq"))
    listed = t.watchlist.select("imo", "mmsi", "callsign", "name", F.col("line_no").alias("seq"))
    return merge.union_first_wins([live, listed], identity.id_dedupe(), "seq").select("grp", "seq")


@query("set02_provider_union", """
WITH u AS (SELECT provider, mmsi, date_trunc('hour', observed_at) AS o, round(latitude, 6) AS la, round(longitude, 6) AS lo FROM v_contacts
 UNION ALL SELECT 'ais_dk_historical', mmsi, date_trunc('hour', seen_at), round(latitude, 6), round(longitude, 6) FROM v_history)
SELECT provider, count(*) AS n FROM (SELECT DISTINCT * FROM u) GROUP BY 1""")
def _(t):
    key = ["provider", "mmsi", "o", "la", "lo"]
    place = (F.round("latitude", 6).alias("la"), F.round("longitude", 6).alias("lo"))
    live = t.contacts.select("provider", "mmsi", F.date_trunc("hour", "observed_at").alias("o"), *place)
    kept = t.history.select(F.lit("ais_dk_historical").alias("provider"), "mmsi",
                                                         F.date_trunc("hour", "seen_at").alias("o"), *place)
    return live.unionByName(kept).dropDuplicates(key).groupBy("provider").agg(F.count("*").alias("n"))


@query("spa09_reference_cleanup", """
WITH f AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 500 AS VARCHAR) END AS fid, p_type, p_size, round(p_retailprice / 7e1, 5) AS lon FROM part),
k AS (SELECT DISTINCT coalesce(fid, p_type || '|' || p_size || '|' || lon) AS key FROM f WHERE lon BETWEEN -6 AND 32)
SELECT count(*) AS kept, (SELECT count(*) FROM f WHERE lon NOT BETWEEN -6 AND 32) AS dropped_geometry,
 (SELECT count(*) FROM f WHERE lon BETWEEN -6 AND 32) - count(*) AS duplicates FROM k""")
def _(t):
    f = t.table("part").select(F.when(F.col("p_partkey") % 3 == 0, (F.col("p_partkey") % 500).cast("string")).alias("fid"), "p_type",
                               "p_size", F.round(F.col("p_retailprice") / 70.0, 5).alias("lon"))
    inside = f.where(F.col("lon").between(-6, 32))
    kept = ref.clean_features(inside, ref.content_identity("fid", "p_type", "p_size", "lon"))
    total = f.agg(F.count_if(~F.col("lon").between(-6, 32)).alias("d"), F.count_if(F.col("lon").between(-6, 32)).alias("i"))
    out = kept.agg(F.count("*").alias("kept"))
    return out.withColumn("dropped_geometry", total.select("d").scalar()).withColumn(
        "duplicates", total.select("i").scalar() - F.col("kept"))


@query("jn20_exact_scene", "SELECT p_partkey FROM part WHERE p_partkey = 77")
def _(t):
    k = F.col("p_partkey").cast("string")
    items = t.table("part").select("p_partkey", F.concat(F.lit("s1_"), k, F.lit("_COG.SAFE")).alias("id"), F.concat(F.lit("x"), k).alias(
        "title"))
    return ref.require_one(ref.find_scene(items, " S1_77_cog.safe "), "p_partkey")


@query("str08_unchanged_input", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def _(t):
    # The same rows in another order have the same fingerprint, so nothing would be rebuilt.
    cols = ("o_orderkey", "o_custkey", "o_orderstatus")
    orders = t.table("orders")
    same = audit.fingerprint(orders, *cols).select("fingerprint").scalar() == audit.fingerprint(
        orders.repartition(3, "o_custkey"), *cols).select("fingerprint").scalar()
    return orders.where(same).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


