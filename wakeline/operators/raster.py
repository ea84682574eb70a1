"""Background-adaptive detection on pixel tables (scene_id, px_row, px_col, vv, vh, valid)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo
from wakeline.functions.records import scaled_round
from wakeline.functions.text import col
from wakeline.operators.graph import connected_components
from wakeline.operators.keyed import chunked_rank, exact_percentiles


def valid_pixels(pixels: DataFrame, mask: str = "mask") -> DataFrame:
    return pixels.withColumn("valid", F.coalesce(F.col(mask) >= 0.5, F.lit(False)))


def box_sums(pixels: DataFrame, bands: dict[str, tuple[int, ...]]) -> DataFrame:
    """Sums and counts of valid values in square boxes: columns ``s_<band>_<r>`` and ``n_<r>``.

    Box sums are separable: one range window along rows, one along columns. A window partition is
    a single image line, so its size is the scene width or height whatever the number of scenes.
    """
    radii = sorted({r for rs in bands.values() for r in rs})
    line = Window.partitionBy("scene_id", "px_row").orderBy("px_col")
    column = Window.partitionBy("scene_id", "px_col").orderBy("px_row")
    one = F.col("valid").cast("int")
    kept = {band: F.when(F.col("valid"), F.col(band)).otherwise(0.0) for band in bands}
    across = pixels.select("*", *[
        F.sum(kept[band]).over(line.rangeBetween(-r, r)).alias(f"_h_{band}_{r}") for band, rs in bands.items()
        for r in rs], *[F.sum(one).over(line.rangeBetween(-r, r)).alias(f"_h_n_{r}") for r in radii])
    down = across.select("*", *[
        F.sum(f"_h_{band}_{r}").over(column.rangeBetween(-r, r)).alias(f"s_{band}_{r}") for band, rs in bands.items()
        for r in rs], *[F.sum(f"_h_n_{r}").over(column.rangeBetween(-r, r)).alias(f"n_{r}") for r in radii])
    return down.select(*[c for c in down.columns if not c.startswith("_h_")])


def cfar_columns(profile: P.CfarProfile, band: str, border: int, fraction: float, height: Column, width: Column
                 ) -> tuple[Column, Column, Column]:
    """(eligible, hit, excess dB) of one profile over ``box_sums`` columns."""
    outer, guard = 2 * profile.training + 1, 2 * profile.guard + 1
    needed = math.ceil((outer * outer - guard * guard) * fraction)
    count = (F.col(f"n_{profile.training}") - F.col(f"n_{profile.guard}")).cast("double")
    total = F.col(f"s_{band}_{profile.training}") - F.col(f"s_{band}_{profile.guard}")
    inner = ((F.col("px_row") >= border) & (F.col("px_row") < height - border)
             & (F.col("px_col") >= border) & (F.col("px_col") < width - border))
    value = F.col(band)
    eligible = F.coalesce(F.col("valid") & (value > 0) & (count >= needed) & inner, F.lit(False))
    safe = F.when(count > 0, count)
    threshold = (total / safe) * (safe * F.expm1(F.lit(-math.log(profile.probability)) / safe))
    hit = F.coalesce(eligible & (threshold > 0) & (value > threshold), F.lit(False))
    return eligible, hit, F.when(hit, 10.0 * F.log10(value / threshold))


def cfar(pixels: DataFrame, profile: P.CfarProfile, band: str, height: int, width: int, fraction: float = 0.8,
         border: int | None = None) -> DataFrame:
    """Hits of one profile: scene, row, col, value and excess dB."""
    sums = box_sums(pixels, {band: (profile.training, profile.guard)})
    edge = profile.training if border is None else border
    _eligible, hit, excess = cfar_columns(profile, band, edge, fraction, F.lit(height), F.lit(width))
    return sums.withColumn("hit", hit).withColumn("excess_db", excess).where("hit").select(
        "scene_id", "px_row", "px_col", F.col(band).alias("value"), "excess_db")


def compare_profiles(pixels: DataFrame, height: int, width: int, params: P.CfarParams = P.CfarParams()) -> DataFrame:
    """Every pixel any VV profile or the VH profile hits, with per-profile hit and excess columns.

    All profiles share the same two window passes.
    """
    border = max(p.training for p in params.profiles)
    vv = tuple(sorted({r for p in params.profiles for r in (p.training, p.guard)}))
    sums = box_sums(pixels, {"vv": vv, "vh": (params.vh_profile.training, params.vh_profile.guard)})
    out, any_hit = sums, F.lit(False)
    for profile, band, name in [*[(p, "vv", p.id) for p in params.profiles], (params.vh_profile, "vh", "vh")]:
        _e, hit, excess = cfar_columns(profile, band, border, params.minimum_fraction, F.lit(height), F.lit(width))
        out = out.withColumn("hit_" + name, hit).withColumn("db_" + name, F.round(excess, 4))
        any_hit = any_hit | F.col("hit_" + name)
    keep = ["scene_id", "px_row", "px_col", "vv", "vh", *[f"{p}_{n}" for n in [x.id for x in params.profiles] + ["vh"]
                                                          for p in ("hit", "db")]]
    return out.where(any_hit).select(*keep)


def seed_counts(hits: DataFrame, params: P.CfarParams = P.CfarParams()) -> DataFrame:
    return hits.groupBy("scene_id").agg(*[
        F.count_if("hit_" + n).alias("seeds_" + n) for n in [p.id for p in params.profiles] + ["vh"]])


def guard_seeds(hits: DataFrame, params: P.CfarParams = P.CfarParams()) -> DataFrame:
    """The hits unchanged; with a seed limit, the job fails when a scene's profile exceeds it."""
    if params.max_seeds is None:
        return hits
    names = [p.id for p in params.profiles] + ["vh"]
    worst = F.greatest(*[F.count_if("hit_" + n) for n in names])
    checked = hits.groupBy("scene_id").agg(worst.alias("_worst")).select("scene_id", F.when(
        F.col("_worst") > params.max_seeds, F.raise_error(F.concat(F.lit("seed limit exceeded in scene "), F.col(
            "scene_id").cast("string")))).otherwise(F.lit(True)).alias("_ok"))
    return hits.join(checked, "scene_id").where("_ok").drop("_ok")


def union_seeds(hits: DataFrame, params: P.CfarParams = P.CfarParams()) -> DataFrame:
    """Pixels hit by any VV profile."""
    any_hit = F.lit(False)
    for p in params.profiles:
        any_hit = any_hit | F.col("hit_" + p.id)
    return hits.where(any_hit)


def seed_key(scene="scene_id", row="px_row", column="px_col") -> Column:
    """Sortable text id of a pixel."""
    return F.concat_ws(":", col(scene).cast("string"), F.lpad(col(row).cast("string"), 7, "0"),
                       F.lpad(col(column).cast("string"), 7, "0"))


def link_edges(seeds: DataFrame, radius: int) -> DataFrame:
    """Edges between seeds at Chebyshev distance up to 2r+1 (what touching after dilation by r means).

    Each seed asks for its fixed set of later neighbour offsets by exact pixel, so the join fans out
    by a constant and no cell's seeds are paired all-with-all.
    """
    reach = 2 * radius + 1
    offsets = [(dr, dc) for dr in range(0, reach + 1) for dc in range(-reach, reach + 1) if dr > 0 or dc > 0]
    steps = F.explode(F.array(*[F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in offsets]))
    asked = seeds.select("scene_id", "px_row", "px_col", steps.alias("o")).select(
        "scene_id", seed_key().alias("u"), (F.col("px_row") + F.col("o.dr")).alias("px_row"),
        (F.col("px_col") + F.col("o.dc")).alias("px_col"))
    there = seeds.select("scene_id", "px_row", "px_col", seed_key().alias("v"))
    return asked.join(there, ["scene_id", "px_row", "px_col"]).select("u", "v")


def label_components(seeds: DataFrame, radius: int) -> DataFrame:
    """Seeds with the ``component`` they belong to (its smallest pixel id)."""
    nodes = seeds.select(seed_key().alias("node"))
    labels = connected_components(nodes, link_edges(seeds, radius))
    return seeds.withColumn("node", seed_key()).join(labels, "node").drop("node")


def measure_components(labelled: DataFrame, vh_hits: DataFrame | None = None,
                       params: P.CfarParams = P.CfarParams()) -> DataFrame:
    """Per component: power-weighted centroid, peak, spans, seed count, profile consensus."""
    names = [p.id for p in params.profiles]
    w = F.greatest(F.lit(0.0), F.col("vv"))
    power = F.sum(w)
    centre = lambda c: F.when(power > 0, F.sum(F.col(c) * w) / power).otherwise(F.avg(c))
    peak = F.max(F.struct(F.col("vv"), (-F.col("px_row")).alias("r"), (-F.col("px_col")).alias("c"), F.col("vh")))
    detected = sum((F.max(F.col("hit_" + n).cast("int")) for n in names), F.lit(0))
    best_db = F.greatest(*[F.max("db_" + n) for n in names])
    out = labelled.groupBy("scene_id", "component").agg(
        F.count("*").alias("seed_pixels"), F.round(centre("px_row"), 3).alias("centroid_row"),
        F.round(centre("px_col"), 3).alias("centroid_col"), peak.alias("_peak"),
        F.min("px_row").alias("row_min"), F.max("px_row").alias("row_max"), F.min("px_col").alias("col_min"),
        F.max("px_col").alias("col_max"), detected.alias("profile_count"), best_db.alias("max_excess_db"),
        F.bool_or("hit_vh").alias("vh_corroborated"))
    count = F.col("profile_count")
    return (out.withColumn("peak_row", -F.col("_peak.r")).withColumn("peak_col", -F.col("_peak.c"))
            .withColumn("vv_peak_db", F.round(10.0 * F.log10("_peak.vv"), 4))
            .withColumn("vh_peak_db", F.when(F.col("_peak.vh") > 0, F.round(10.0 * F.log10("_peak.vh"), 4)))
            .withColumn("consensus", F.when(count == len(names), "ALL_PROFILES").when(count > 1, "MULTI_PROFILE")
                        .otherwise("SINGLE_PROFILE")).drop("_peak"))


def number_candidates(components: DataFrame, scene_tag: Column, params: P.CfarParams = P.CfarParams()) -> DataFrame:
    """Candidates numbered per scene by strength; with a limit, more than that in a scene fails the job.

    Numbers run over steps of a decibel, so a scene with very many candidates is not one window.
    """
    order = [F.col("max_excess_db").desc(), F.col("vv_peak_db").desc(), F.col("peak_row").asc(),
             F.col("peak_col").asc()]
    ranked = chunked_rank(components, ["scene_id"], -F.floor("max_excess_db"), order, "n")
    label = F.concat(F.lit("SARCAND-"), scene_tag, F.lit("-"), F.lpad(F.col("n").cast("string"), F.greatest(F.lit(4), F.length(F.col("n").cast("string"))), F.lit("0")))
    if params.max_candidates is not None:
        label = F.when(F.col("n") > params.max_candidates, F.raise_error(F.lit("candidate limit exceeded"))).otherwise(label)
    return ranked.withColumn("detection_id", label)


def quality_flags(near_infrastructure: Column, reference_available: Column) -> Column:
    return F.array_compact(F.array(
        F.lit("COARSE_LAND_MASK_APPLIED"), F.lit("LAND_MASK_GENERALIZATION_REVIEW_REQUIRED"),
        F.when(F.col("profile_count") == 1, "SINGLE_PROFILE_ONLY"),
        F.when(F.col("seed_pixels") == 1, "SINGLE_PIXEL_SIGNATURE"),
        F.when(F.col("vh_corroborated"), "VH_CFAR_CORROBORATED"),
        F.when(near_infrastructure, "NEAR_INFRASTRUCTURE_REFERENCE"),
        F.when(~reference_available, "INFRASTRUCTURE_REFERENCE_UNAVAILABLE")))


def band_statistics(pixels: DataFrame, band: str, probabilities=(0.5, 0.9, 0.95, 0.99, 0.999)) -> DataFrame:
    """Per scene: linear and dB count, min, max, mean, deviation and exact percentiles."""
    long = pixels.where("valid").select("scene_id", F.col(band).alias("v"))
    both = long.select("scene_id", F.lit("linear").alias("scale"), "v").unionByName(
        long.where("v > 0").select("scene_id", F.lit("decibel").alias("scale"), (10.0 * F.log10("v")).alias("v")))
    basic = both.groupBy("scene_id", "scale").agg(
        F.count("*").alias("samples"), scaled_round(F.min("v"), 6).alias("min"), scaled_round(F.max("v"), 6).alias("max"),
        scaled_round(F.avg("v"), 6).alias("mean"), scaled_round(F.stddev_pop("v"), 6).alias("stddev"))
    # Steps of about 1.6 %, whatever the scale: linear values far below 1 spread like decibels do. Of the magnitude, as
    # the function loses all digits of large negative values and is not monotone there.
    bucket = F.floor(F.signum("v") * F.asinh(F.abs("v") * 1e6) * 64.0).cast("bigint")
    pct = exact_percentiles(both, ["scene_id", "scale"], "v", probabilities, bucket)
    wide = pct.groupBy("scene_id", "scale").agg(*[
        F.max(F.when(F.abs(F.col("p") - p) < 1e-9, F.col("value"))).alias(f"p{str(p * 100).rstrip('0').rstrip('.')}"
                                                                          .replace(".", "_")) for p in probabilities])
    return basic.join(wide, ["scene_id", "scale"])


def land_pixels(pixels: DataFrame, rings: DataFrame, height: int, width: int, bbox: tuple) -> DataFrame:
    """Pixels whose centre lies on land (rings in lon/lat, holes included)."""
    from wakeline.operators.spatial import inside_polygon

    lon, lat = geo.pixel_to_lonlat(F.col("px_row"), F.col("px_col"), height, width, *map(F.lit, bbox))
    points = pixels.select("scene_id", "px_row", "px_col", lon.alias("longitude"), lat.alias("latitude"))
    band = (bbox[3] - bbox[1]) / height
    keys = ["scene_id", "px_row", "px_col"]
    return inside_polygon(points, rings, keys, band).select(*keys).distinct()


def land_buffer(land: DataFrame, radius: int) -> DataFrame:
    """Pixels within ``radius`` (Euclidean) of land.

    Row by row: land runs are widened by the reach left at each row offset, so a land pixel fans out
    over 2r+1 rows instead of the whole disc; only run ends are needed.
    """
    w = Window.partitionBy("scene_id", "px_row").orderBy("px_col")
    runs = (land.withColumn("_g", F.col("px_col") - F.row_number().over(w))
            .groupBy("scene_id", "px_row", "_g").agg(F.min("px_col").alias("c0"), F.max("px_col").alias("c1")))
    spread = runs.withColumn("_d", F.explode(F.sequence(F.lit(-radius), F.lit(radius))))
    reach = F.floor(F.sqrt(F.lit(float(radius * radius)) - F.col("_d") * F.col("_d"))).cast("int")
    return spread.select("scene_id", (F.col("px_row") + F.col("_d")).alias("px_row"),
                         (F.col("c0") - reach).alias("c0"), (F.col("c1") + reach).alias("c1"))


def mask_land(pixels: DataFrame, land: DataFrame, radius: int) -> DataFrame:
    """Pixels with ``valid`` switched off on land and in its buffer."""
    spans = land_buffer(land, radius)
    size = 64
    cells = spans.withColumn("_c", F.explode(F.sequence(geo.cell(F.col("c0"), size), geo.cell(F.col("c1"), size))))
    p = pixels.withColumn("_c", geo.cell(F.col("px_col"), size))
    hit = (p.select("scene_id", "px_row", "px_col", "_c").join(cells, ["scene_id", "px_row", "_c"])
           .where(F.col("px_col").between(F.col("c0"), F.col("c1")))
           .select("scene_id", "px_row", "px_col").distinct().withColumn("_land", F.lit(True)))
    return (pixels.join(hit, ["scene_id", "px_row", "px_col"], "left")
            .withColumn("valid", F.col("valid") & F.col("_land").isNull()).drop("_land"))
