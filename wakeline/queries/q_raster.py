"""Pixel tables: adaptive detection, components, statistics and land masks."""

from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.operators import raster
from wakeline.queries.fixtures import SCENE_SIZE
from wakeline.queries.registry import query

CFAR = P.CfarParams()
N = SCENE_SIZE
BOX = (8.0, 54.0, 10.0, 56.0)


def _sums(band: str, radii) -> str:
    h = ", ".join(f"sum(CASE WHEN valid THEN {band} ELSE 0e0 END) OVER (PARTITION BY scene_id, px_row ORDER BY px_col RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS h{band}{r},"
                  f" sum(valid::INT) OVER (PARTITION BY scene_id, px_row ORDER BY px_col RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS hn{band}{r}" for r in radii)
    v = ", ".join(f"sum(h{band}{r}) OVER (PARTITION BY scene_id, px_col ORDER BY px_row RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS s{band}{r},"
                  f" sum(hn{band}{r}) OVER (PARTITION BY scene_id, px_col ORDER BY px_row RANGE BETWEEN {r} PRECEDING AND {r} FOLLOWING) AS n{band}{r}" for r in radii)
    return f"h_{band} AS (SELECT *, {h} FROM v_pixels), b_{band} AS (SELECT *, {v} FROM h_{band})"


def _excess(p: P.CfarProfile, band: str, border: int, alias: str = "") -> str:
    """Excess dB where the profile hits, else NULL."""
    import math

    a = alias
    outer, guard = 2 * p.training + 1, 2 * p.guard + 1
    need = math.ceil((outer * outer - guard * guard) * CFAR.minimum_fraction)
    n = f"({a}n{band}{p.training} - {a}n{band}{p.guard})::DOUBLE"
    total = f"({a}s{band}{p.training} - {a}s{band}{p.guard})"
    thr = f"({total} / {n} * ({n} * (exp({-math.log(p.probability)!r}e0 / {n}) - 1e0)))"
    return (f"CASE WHEN {a}valid AND {a}{band} > 0 AND {n} >= {need} AND {a}px_row >= {border} AND {a}px_row < {N - border} AND {a}px_col >= {border} AND {a}px_col < {N - border}"
            f" AND {thr} > 0 AND {a}{band} > {thr} THEN 10e0 * log10({a}{band} / {thr}) END")


_VV = _sums("vv", (2, 3, 4, 11, 15, 17))
_VH = _sums("vh", (3, 15))
_P = {p.id: p for p in CFAR.profiles}
HITS = f"""{_VV}, {_VH}, hx AS (SELECT b.scene_id, b.px_row, b.px_col, b.vv, b.vh, {', '.join(f"round({_excess(p, 'vv', 17, 'b.')}, 4) AS db_{p.id}" for p in CFAR.profiles)},
 round({_excess(CFAR.vh_profile, 'vh', 17, 'c.')}, 4) AS db_vh FROM b_vv b JOIN b_vh c USING (scene_id, px_row, px_col)),
seeds AS (SELECT *, scene_id || ':' || px_row || ':' || px_col AS id FROM hx WHERE db_strict_wide IS NOT NULL OR db_balanced IS NOT NULL OR db_exploratory_local IS NOT NULL)"""
COMPONENTS = HITS + """, ed AS (SELECT a.id AS u, b.id AS v FROM seeds a JOIN seeds b ON a.scene_id = b.scene_id AND abs(a.px_row - b.px_row) <= 3 AND abs(a.px_col - b.px_col) <= 3),
r(n, c) AS (SELECT id, id FROM seeds UNION SELECT r.n, ed.v FROM r JOIN ed ON ed.u = r.c),
lab AS (SELECT seeds.*, k.comp FROM seeds JOIN (SELECT n, min(lpad(split_part(c, ':', 1), 7, '0') || ':' || lpad(split_part(c, ':', 2), 7, '0') || ':' || lpad(split_part(c, ':', 3), 7, '0')) AS comp FROM r GROUP BY 1) k ON k.n = seeds.id),
meas AS (SELECT scene_id, comp, count(*) AS seed_pixels, round(sum(px_row * vv) / sum(vv), 3) AS centroid_row, round(sum(px_col * vv) / sum(vv), 3) AS centroid_col,
 arg_max(px_row, (vv, -px_row, -px_col)) AS peak_row, arg_max(px_col, (vv, -px_row, -px_col)) AS peak_col, round(10e0 * log10(max(vv)), 4) AS vv_peak_db,
 (max(db_strict_wide) IS NOT NULL)::INT + (max(db_balanced) IS NOT NULL)::INT + (max(db_exploratory_local) IS NOT NULL)::INT AS profile_count,
 greatest(max(db_strict_wide), max(db_balanced), max(db_exploratory_local)) AS max_excess_db, max(db_vh) IS NOT NULL AS vh_corroborated, min(px_row) AS row_min, max(px_row) AS row_max FROM lab GROUP BY ALL)"""


def hits(t):
    return raster.compare_profiles(t.pixels, N, N, CFAR)


def labelled(t):
    seeds = raster.union_seeds(raster.guard_seeds(hits(t), CFAR), CFAR)
    return raster.label_components(seeds, CFAR.link_radius)


def measured(t):
    return raster.measure_components(labelled(t))


@query("src13_pixel_scan", "SELECT scene_id, px_row, px_col, mask >= 5e-1 AS valid FROM v_pixels")
def _(t):
    return raster.valid_pixels(t.pixels.drop("valid")).select("scene_id", "px_row", "px_col", "valid")


@query("win14_box_sums", f"WITH {_sums('vv', (3,))} SELECT scene_id, px_row, px_col, round(svv3, 8) AS s, nvv3::BIGINT AS n FROM b_vv")
def _(t):
    return raster.box_sums(t.pixels, {"vv": (3,)}).select("scene_id", "px_row", "px_col", F.round("s_vv_3", 8).alias("s"), F.col("n_3").alias("n"))


@query("ras01_cfar", f"""
WITH {_sums('vv', (2, 10))}, h AS (SELECT *, {_excess(P.CfarProfile('t', 10, 2, 1e-5), 'vv', 10)} AS db FROM b_vv) SELECT scene_id, px_row, px_col, round(vv, 8) AS value, round(db, 4) AS excess_db FROM h WHERE db IS NOT NULL""")
def _(t):
    return raster.cfar(t.pixels, P.CfarProfile("t", 10, 2, 1e-5), "vv", N, N).withColumns(
        {"value": F.round("value", 8), "excess_db": F.round("excess_db", 4)})


@query("ras02_profiles", f"""
WITH {HITS} SELECT scene_id, px_row, px_col, db_strict_wide, db_balanced, db_exploratory_local, db_vh FROM hx WHERE coalesce(db_strict_wide, db_balanced, db_exploratory_local, db_vh) IS NOT NULL""")
def _(t):
    return hits(t).select("scene_id", "px_row", "px_col", "db_strict_wide", "db_balanced", "db_exploratory_local", "db_vh")


@query("ras02_seed_counts", f"""
WITH {HITS} SELECT scene_id, count(db_strict_wide) AS seeds_strict_wide, count(db_balanced) AS seeds_balanced, count(db_exploratory_local) AS seeds_exploratory_local, count(db_vh) AS seeds_vh
FROM hx GROUP BY 1 HAVING count(coalesce(db_strict_wide, db_balanced, db_exploratory_local, db_vh)) > 0""")
def _(t):
    return raster.seed_counts(hits(t))


@query("ras03_seed_union", f"WITH {HITS} SELECT scene_id, px_row, px_col FROM seeds")
def _(t):
    return raster.union_seeds(raster.guard_seeds(hits(t), CFAR)).select("scene_id", "px_row", "px_col")


@query("ras04_profile_consensus", f"""
WITH RECURSIVE {COMPONENTS} SELECT scene_id, comp AS component, CASE WHEN profile_count = 3 THEN 'ALL_PROFILES' WHEN profile_count > 1 THEN 'MULTI_PROFILE' ELSE 'SINGLE_PROFILE' END AS consensus, vh_corroborated FROM meas""")
def _(t):
    return _padded(measured(t)).select("scene_id", "component", "consensus", "vh_corroborated")


def _padded(df):
    parts = F.split("component", ":")
    return df.withColumn("component", F.concat_ws(":", F.lpad(parts[0], 7, "0"), parts[1], parts[2]))


@query("ras05_components", f"WITH RECURSIVE {COMPONENTS} SELECT scene_id, px_row, px_col, comp AS component FROM lab")
def _(t):
    return _padded(labelled(t)).select("scene_id", "px_row", "px_col", "component")


@query("ras06_measurement", f"""
WITH RECURSIVE {COMPONENTS} SELECT scene_id, comp AS component, seed_pixels, centroid_row, centroid_col, peak_row, peak_col, vv_peak_db, max_excess_db, row_min, row_max FROM meas""")
def _(t):
    return _padded(measured(t)).select("scene_id", "component", "seed_pixels", "centroid_row", "centroid_col", "peak_row", "peak_col",
                                       "vv_peak_db", "max_excess_db", "row_min", "row_max")


@query("ras07_quality_flags", f"""
WITH RECURSIVE {COMPONENTS} SELECT scene_id, comp AS component, concat_ws(',', 'COARSE_LAND_MASK_APPLIED', 'LAND_MASK_GENERALIZATION_REVIEW_REQUIRED', CASE WHEN profile_count = 1 THEN 'SINGLE_PROFILE_ONLY' END,
 CASE WHEN seed_pixels = 1 THEN 'SINGLE_PIXEL_SIGNATURE' END, CASE WHEN vh_corroborated THEN 'VH_CFAR_CORROBORATED' END, CASE WHEN peak_row < 30 THEN 'NEAR_INFRASTRUCTURE_REFERENCE' END) AS flags FROM meas""")
def _(t):
    return _padded(measured(t)).select("scene_id", "component", F.array_join(raster.quality_flags(
        F.col("peak_row") < 30, F.lit(True)), ",").alias("flags"))


@query("ord06_candidate_numbers", f"""
WITH RECURSIVE {COMPONENTS} SELECT scene_id, comp AS component, 'SARCAND-' || scene_id || '-' || lpad(CAST(row_number() OVER (PARTITION BY scene_id ORDER BY max_excess_db DESC, vv_peak_db DESC, peak_row, peak_col) AS VARCHAR), 4, '0') AS detection_id FROM meas""")
def _(t):
    return _padded(raster.number_candidates(measured(t), F.col("scene_id").cast("string"))).select("scene_id", "component", "detection_id")


@query("agg18_band_statistics", """
WITH v AS (SELECT scene_id, 'linear' AS scale, vv AS x FROM v_pixels WHERE valid UNION ALL SELECT scene_id, 'decibel', 10e0 * log10(vv) FROM v_pixels WHERE valid AND vv > 0)
SELECT scene_id, scale, count(*) AS samples, round(min(x), 6) AS min, round(max(x), 6) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS stddev, round(quantile_cont(x, 0.5), 6) AS p50,
 round(quantile_cont(x, 0.9), 6) AS p90, round(quantile_cont(x, 0.95), 6) AS p95, round(quantile_cont(x, 0.99), 6) AS p99, round(quantile_cont(x, 0.999), 6) AS p99_9 FROM v GROUP BY ALL""")
def _(t):
    return raster.band_statistics(t.pixels, "vv")


def _land(t):
    """A rectangular island per scene table: rows and columns 20.2 to 30.2 of the scene box."""
    lon = lambda c: BOX[0] + c / N * (BOX[2] - BOX[0])
    lat = lambda r: BOX[3] - r / N * (BOX[3] - BOX[1])
    corner = [(lon(20.2), lat(20.2)), (lon(30.2), lat(20.2)), (lon(30.2), lat(30.2)), (lon(20.2), lat(30.2)), (lon(20.2), lat(20.2))]
    edges = [F.struct(F.lit(a[0]).alias("a_lon"), F.lit(a[1]).alias("a_lat"), F.lit(b[0]).alias("b_lon"), F.lit(b[1]).alias("b_lat"))
             for a, b in zip(corner, corner[1:])]
    return t.spark.range(1).select(F.lit("island").alias("feature_id"), F.explode(F.array(*edges)).alias("e")).select("feature_id", "e.*")


@query("spa05_land_mask", """
WITH land AS (SELECT scene_id, px_row, px_col FROM v_pixels WHERE px_row BETWEEN 20 AND 29 AND px_col BETWEEN 20 AND 29)
SELECT scene_id, px_row, px_col FROM v_pixels p WHERE valid AND NOT EXISTS (SELECT 1 FROM land l WHERE l.scene_id = p.scene_id
 AND (l.px_row - p.px_row) * (l.px_row - p.px_row) + (l.px_col - p.px_col) * (l.px_col - p.px_col) <= 25)""")
def _(t):
    land = raster.land_pixels(t.pixels, _land(t), N, N, BOX)
    return raster.mask_land(t.pixels, land, 5).where("valid").select("scene_id", "px_row", "px_col")


