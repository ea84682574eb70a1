"""As-of reads, common watermark, bracketing observations and projections."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import identity
from wakeline.operators import radar, snapshot
from wakeline.queries import fragments as S
from wakeline.queries.fixtures import SCENE_AT
from wakeline.queries.q_filters import WINDOW_MIN
from wakeline.queries.registry import query
from wakeline.sources import feeds

_AGE = "CASE provider WHEN 'fintraffic' THEN 16 WHEN 'barentswatch' THEN 16 WHEN 'aisstream' THEN 12 ELSE 24 END"
_RANK = "CASE provider WHEN 'barentswatch' THEN 1 WHEN 'fintraffic' THEN 2 WHEN 'ais_dk_historical' THEN 3 WHEN 'global_fishing_watch' THEN 4 ELSE 99 END"
ASOF = f"""pos AS (SELECT event_id, provider, {S.ID_COMMON} AS identity_key, observed_at, latitude, longitude, timestamp_valid FROM v_contacts),
t AS (SELECT date_trunc('hour', max(observed_at)) AS at0 FROM pos WHERE provider = 'global_fishing_watch'),
el AS (SELECT pos.*, at0, epoch_us(at0 - observed_at) / 6e7 AS age FROM pos, t WHERE observed_at <= at0 AND epoch_us(at0 - observed_at) / 36e8 <= {_AGE}),
rk AS (SELECT *, row_number() OVER w AS n, lead(latitude) OVER w AS prev_latitude FROM el WINDOW w AS (PARTITION BY provider, identity_key ORDER BY observed_at DESC, event_id DESC)),
sel AS (SELECT *, round(age, 1) AS age1 FROM rk WHERE n = 1),
can AS (SELECT *, row_number() OVER (PARTITION BY identity_key ORDER BY age1, CASE WHEN timestamp_valid THEN 0 ELSE 1 END, CASE WHEN provider <> 'global_fishing_watch' THEN 0 ELSE 1 END,
 {_RANK}, provider) AS c, count(*) OVER (PARTITION BY identity_key) AS candidates FROM sel)"""


def positions(t):
    c = t.contacts.withColumns({"position_timestamp_valid": F.col("timestamp_valid"), "position_timestamp_basis": F.lit(None).cast("string")})
    rows = feeds.position_record(c)
    return rows.withColumn("observed_at", F.col("observed_at"))


def raw_positions(t):
    return t.contacts.select("event_id", "provider", identity.id_common().alias("identity_key"), "observed_at", "latitude", "longitude",
                             "timestamp_valid", (F.col("provider") != "global_fishing_watch").alias("position_is_exact"))


def watermark(rows):
    return snapshot.common_watermark(rows, "observed_at").scalar()


def selected(t):
    rows = raw_positions(t)
    return snapshot.pick_as_of(rows, watermark(rows), snapshot.max_age(), "observed_at", "event_id")


@query("jn09_as_of_pick", f"WITH {ASOF} SELECT provider, identity_key, event_id, age1 AS age, round(prev_latitude, 6) AS prev_latitude FROM sel")
def _(t):
    return selected(t).select("provider", "identity_key", "event_id", F.col("age_at_snapshot_minutes").alias("age"),
                              F.round("previous_position.latitude", 6).alias("prev_latitude"))


@query("agg15_canonical_provider", f"WITH {ASOF} SELECT identity_key, provider, event_id, candidates FROM can WHERE c = 1")
def _(t):
    return snapshot.canonical(selected(t)).select("identity_key", "provider", "event_id", F.col("provider_candidate_count").alias("candidates"))


@query("str05_common_watermark", f"WITH {ASOF} SELECT epoch(at0)::BIGINT AS sec FROM t")
def _(t):
    return snapshot.common_watermark(raw_positions(t), "observed_at").select(F.unix_seconds("snapshot_at").alias("sec"))


@query("agg14_coverage_state", f"""
WITH {ASOF}, cov AS (SELECT provider, date_trunc('hour', observed_at) AS c FROM v_contacts GROUP BY ALL),
r AS (SELECT provider, max(CASE WHEN c <= at0 + CASE provider WHEN 'ais_dk_historical' THEN INTERVAL 24 HOUR ELSE INTERVAL 0 HOUR END
 AND c >= at0 - {_AGE} * INTERVAL 1 HOUR THEN c END) AS p, min(c) AS lo, max(c) AS hi FROM cov, t GROUP BY 1), s AS (SELECT provider, count(*) AS n FROM sel GROUP BY 1)
SELECT m.provider, epoch(p)::BIGINT AS point, coalesce(n, 0) AS selected_contacts, CASE WHEN p IS NULL AND lo > at0 THEN 'warming_up' WHEN p IS NULL THEN 'missing_at_watermark'
 WHEN coalesce(n, 0) = 0 THEN 'ready_no_retained_contacts' ELSE 'ready' END AS state
FROM (SELECT unnest(['global_fishing_watch', 'ais_dk_historical', 'fintraffic', 'barentswatch']) AS provider) m LEFT JOIN r USING (provider) LEFT JOIN s USING (provider), t""")
def _(t):
    rows = raw_positions(t)
    cover = rows.select("provider", F.date_trunc("hour", "observed_at").alias("coverage_at")).distinct()
    at = watermark(rows)
    out = snapshot.coverage_state(cover, selected(t), at)
    return out.select("provider", F.unix_seconds("coverage_point").alias("point"), "selected_contacts", "state")


@query("agg25_coverage_time", """
SELECT provider, epoch(CASE provider WHEN 'fintraffic' THEN max(date_trunc('day', observed_at)) WHEN 'barentswatch' THEN max(date_trunc('hour', observed_at))
 ELSE date_trunc('second', max(observed_at)) END)::BIGINT AS sec, CASE provider WHEN 'fintraffic' THEN 'data_max' WHEN 'barentswatch' THEN 'generated_at' ELSE 'max_normalized_observation' END AS basis,
 count(*) AS contact_count FROM v_contacts GROUP BY 1""")
def _(t):
    rows = t.contacts.withColumns({
        "data_max": F.when(F.col("provider") == "fintraffic", F.date_trunc("day", "observed_at")),
        "generated_at": F.when(F.col("provider").isin("fintraffic", "barentswatch"), F.date_trunc("hour", "observed_at"))})
    return snapshot.coverage_time(rows, ["data_max", "generated_at"], "observed_at").select(
        "provider", F.unix_seconds("coverage_at").cast("bigint").alias("sec"), F.col("coverage_basis").alias("basis"), "contact_count")


# --- radar scene: nearest observations and projection ---------------------------------

PARAMS_M = P.MatchParams(window_minutes=WINDOW_MIN)
_T = f"epoch(TIMESTAMP '{SCENE_AT}')::BIGINT"
BRACKET = f"""win AS (SELECT *, date_trunc('second', observed_at) AS o, CASE WHEN date_trunc('second', observed_at) <= TIMESTAMP '{SCENE_AT}' THEN 'before' ELSE 'after' END AS side
 FROM v_contacts WHERE observed_at BETWEEN TIMESTAMP '{SCENE_AT}' - INTERVAL {WINDOW_MIN} MINUTE AND TIMESTAMP '{SCENE_AT}' + INTERVAL {WINDOW_MIN} MINUTE
 AND CAST(observed_at AS DATE) = DATE '{SCENE_AT[:10]}'),
b1 AS (SELECT *, row_number() OVER (PARTITION BY mmsi, o ORDER BY row_bytes DESC, event_id) AS d FROM win),
br AS (SELECT *, row_number() OVER (PARTITION BY mmsi, side ORDER BY abs(epoch(o)::BIGINT - {_T})) AS rank FROM b1 WHERE d = 1)"""


def bracketed(t):
    from wakeline.operators.filters import in_scene_window

    rows = t.contacts.where(in_scene_window(F.col("observed_at"), t.scene_at, WINDOW_MIN)).withColumn(
        "observed_at", F.date_trunc("second", "observed_at"))
    return snapshot.bracketing(rows, t.scene_at, "mmsi", "observed_at", F.col("row_bytes"), "event_id")


@query("jn10_bracketing", f"WITH {BRACKET} SELECT mmsi, side, event_id, rank FROM br WHERE rank <= 4")
def _(t):
    return bracketed(t).select("mmsi", "side", "event_id", F.col("rank").cast("bigint").alias("rank"))


_HM = S.haversine_m("b.longitude", "b.latitude", "a.longitude", "a.latitude")
_ARC = f"(abs(sgn) / {P.EARTH_RADIUS_M})"
_HD = f"radians(CASE WHEN sgn < 0 THEN {S.fmod('ncog + 18e1', '36e1')} ELSE ncog END)"
_SP = f"(sin(radians(nlat)) * cos({_ARC}) + cos(radians(nlat)) * sin({_ARC}) * cos({_HD}))"
PROJECTED = f"""{BRACKET}, pb AS (SELECT * FROM br WHERE side = 'before' AND rank = 1), pa AS (SELECT * FROM br WHERE side = 'after' AND rank = 1),
pj AS (SELECT coalesce(b.mmsi, a.mmsi) AS mmsi, b.mmsi IS NOT NULL AS hb, a.mmsi IS NOT NULL AS ha, epoch(b.o)::BIGINT AS bt, epoch(a.o)::BIGINT AS ta,
 b.longitude AS blon, b.latitude AS blat, a.longitude AS alon, a.latitude AS alat, b.sog AS bsog, b.cog AS bcog, {_HM} AS len, {S.bearing('b.longitude', 'b.latitude', 'a.longitude', 'a.latitude')} AS brg,
 coalesce(b.longitude, a.longitude) AS nlon, coalesce(b.latitude, a.latitude) AS nlat, coalesce(b.sog, a.sog) AS nsog, coalesce(b.cog, a.cog) AS ncog,
 {_T} - epoch(coalesce(b.o, a.o))::BIGINT AS delta FROM pb b FULL JOIN pa a ON a.mmsi = b.mmsi),
pk AS (SELECT *, CASE WHEN hb AND bt = {_T} THEN 'EXACT_ARCHIVE_OBSERVATION' WHEN hb AND ha THEN 'LINEAR_INTERPOLATION_BRACKETED' WHEN nsog BETWEEN 0 AND 102.1 AND ncog >= 0 AND ncog < 360
 THEN 'SOG_COG_EXTRAPOLATION_SINGLE_SIDED' ELSE 'NEAREST_OBSERVATION_NO_MOTION_MODEL' END AS method, ({_T} - bt) / (ta - bt)::DOUBLE AS f, nsog * 1852e0 * (delta / 36e2) AS sgn FROM pj),
proj AS (SELECT mmsi, method, round(CASE method WHEN 'EXACT_ARCHIVE_OBSERVATION' THEN blon WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN blon + f * (alon - blon)
  WHEN 'SOG_COG_EXTRAPOLATION_SINGLE_SIDED' THEN {S.fmod(f"degrees(radians(nlon) + atan2(sin({_HD}) * sin({_ARC}) * cos(radians(nlat)), cos({_ARC}) - sin(radians(nlat)) * sin(asin({_SP})))) + 54e1", '36e1')} - 18e1 ELSE nlon END, 7) AS plon,
 round(CASE method WHEN 'EXACT_ARCHIVE_OBSERVATION' THEN blat WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN blat + f * (alat - blat) WHEN 'SOG_COG_EXTRAPOLATION_SINGLE_SIDED' THEN degrees(asin({_SP})) ELSE nlat END, 7) AS plat,
 CASE method WHEN 'EXACT_ARCHIVE_OBSERVATION' THEN 0 WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN least({_T} - bt, ta - {_T}) ELSE abs(delta) END AS gap,
 round(CASE method WHEN 'EXACT_ARCHIVE_OBSERVATION' THEN 0 WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN least(len * f, len * (1 - f)) WHEN 'SOG_COG_EXTRAPOLATION_SINGLE_SIDED' THEN abs(sgn) ELSE 0 END, 2) AS motion,
 CASE method WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN len / 1852e0 / ((ta - bt) / 36e2) END AS dsog FROM pk),
prj AS (SELECT *, CASE method WHEN 'EXACT_ARCHIVE_OBSERVATION' THEN 'HIGH' WHEN 'NEAREST_OBSERVATION_NO_MOTION_MODEL' THEN 'LOW' WHEN 'LINEAR_INTERPOLATION_BRACKETED' THEN
 CASE WHEN dsog > 102.1 THEN 'LOW' WHEN gap <= 300 THEN 'HIGH' WHEN gap <= 900 THEN 'MEDIUM' ELSE 'LOW' END ELSE CASE WHEN gap <= 900 THEN 'MEDIUM' ELSE 'LOW' END END AS quality FROM proj)"""


def projected(t):
    return radar.project_tracks(bracketed(t), t.scene_at)


@query("spa06_projection", f"WITH {PROJECTED} SELECT mmsi, method, quality, round(plon, 6) AS plon, round(plat, 6) AS plat, gap, round(motion, 1) AS motion FROM prj")
def _(t):
    return projected(t).select(
        "mmsi", F.col("projection_method").alias("method"), F.col("projection_quality").alias("quality"),
        F.round("projected_longitude", 6).alias("plon"), F.round("projected_latitude", 6).alias("plat"),
        F.col("nearest_gap_seconds").alias("gap"), F.round("motion_distance_m", 1).alias("motion"))


@query("agg13_label_counts", f"""
WITH {PROJECTED} SELECT label, count(quality) AS n FROM (SELECT unnest(['HIGH', 'MEDIUM', 'LOW']) AS label) LEFT JOIN prj ON quality = label GROUP BY 1""")
def _(t):
    return radar.label_counts(projected(t), "projection_quality", ("HIGH", "MEDIUM", "LOW"))


@query("spa08_local_context", f"""
WITH {PROJECTED} SELECT mmsi FROM prj WHERE plat BETWEEN 55e0 - 1e1 / 6e1 AND 57e0 + 1e1 / 6e1 AND plon BETWEEN 1e1 - 1e1 / (6e1 * cos(radians(56e0))) AND 2e1 + 1e1 / (6e1 * cos(radians(56e0)))""")
def _(t):
    return radar.local_context(projected(t), *map(F.lit, (10.0, 55.0, 20.0, 57.0)), 10.0).select("mmsi")


_BIN = f"least(143, floor((epoch(observed_at) - epoch(TIMESTAMP '2024-01-15')) / 600))"


@query("agg11_coverage_summary", f"""
WITH {BRACKET}, d AS (SELECT DISTINCT mmsi, observed_at, latitude, longitude FROM win), a AS (SELECT count(*) AS distinct_messages, count(DISTINCT mmsi) AS distinct_mmsi,
 count(DISTINCT {_BIN}) AS occupied_bins FROM d), s AS (SELECT *, distinct_messages >= 30 AND distinct_mmsi >= 3 AND occupied_bins >= 5 AS sufficient FROM a)
SELECT *, 144 AS total_bins, CASE WHEN sufficient THEN 'AVAILABLE_AIS_ACTIVITY_OBSERVED' ELSE 'NO_AIS_COVERAGE' END AS status FROM s""")
def _(t):
    from wakeline.operators.filters import in_scene_window

    rows = t.contacts.where(in_scene_window(F.col("observed_at"), t.scene_at, WINDOW_MIN))
    return radar.coverage_summary(rows, F.lit("2024-01-15").cast("timestamp"), 144, "observed_at", PARAMS_M)


@query("str06_tumbling_bins", f"""
WITH {BRACKET}, d AS (SELECT DISTINCT mmsi, observed_at, latitude, longitude FROM win) SELECT b AS bin, count(mmsi) AS messages
FROM range(144) r(b) LEFT JOIN d ON CAST({_BIN} AS INT) = b GROUP BY 1""")
def _(t):
    from wakeline.operators.filters import in_scene_window

    rows = t.contacts.where(in_scene_window(F.col("observed_at"), t.scene_at, WINDOW_MIN))
    return radar.coverage_bins(rows, F.lit("2024-01-15").cast("timestamp"), 144, "observed_at", PARAMS_M)


