"""Review objects: grouped radar candidates with three separate quality labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions import geo

FRAGMENTS = "COURSE_AND_LENGTH_ALIGNED_FRAGMENT_CLUSTER"
SINGLE = "SINGLE_CANDIDATE"


def detection_label(max_profiles: Column, any_vh: Column, params: P.ReviewParams) -> Column:
    return (F.when((max_profiles >= params.high_profiles) & any_vh, "HIGH")
            .when(max_profiles >= params.medium_profiles, "MEDIUM").otherwise("LOW"))


def data_label(coverage_ok: Column, bins_complete: Column, max_gap: Column, all_high: Column, all_medium: Column,
               params: P.ReviewParams) -> Column:
    return (F.when(coverage_ok & bins_complete & (max_gap <= params.high_gap_seconds) & all_high, "HIGH")
            .when(coverage_ok & all_medium, "MEDIUM").otherwise("LOW"))


def quality_labels(members: DataFrame, params: P.ReviewParams = P.ReviewParams(), key: str = "object_id") -> DataFrame:
    """Detection and data labels per object.

    Members: profile_count, vh_corroborated, gap_seconds, projection_quality, coverage_ok, bins_complete.
    """
    quality = F.col("projection_quality")
    per = members.groupBy(key).agg(
        F.max("profile_count").alias("max_profiles"), F.bool_or("vh_corroborated").alias("any_vh"),
        F.max("gap_seconds").alias("max_gap"), F.bool_and(quality == "HIGH").alias("all_high"),
        F.bool_and(quality.isin("HIGH", "MEDIUM")).alias("all_medium"),
        F.bool_and("coverage_ok").alias("ok"), F.bool_and("bins_complete").alias("full"),
        F.count("*").alias("member_count"))
    return per.select(
        key, "member_count",
        detection_label(F.col("max_profiles"), F.col("any_vh"), params).alias("detection_quality"),
        data_label(F.col("ok"), F.col("full"), F.col("max_gap"), F.col("all_high"), F.col("all_medium"), params
                   ).alias("data_quality"))


def fragment_checks(members: DataFrame, params: P.ReviewParams = P.ReviewParams(), key: str = "object_id"
                    ) -> DataFrame:
    """Geometry of two-member objects: separation against length, alignment with the course, closeness.

    Members: detection_id, is_representative, longitude, latitude, mmsi, projected_longitude,
    projected_latitude, effective_cog, length_m, within_dynamic_radius. Grouped, not self-joined.
    """
    rep, other = F.col("is_representative"), ~F.col("is_representative")
    pick = lambda cond, c: F.max(F.when(cond, F.col(c)))
    g = members.groupBy(key).agg(
        F.count("*").alias("n"), *[pick(rep, c).alias("r_" + c) for c in (
            "longitude", "latitude", "projected_longitude", "projected_latitude", "effective_cog", "length_m")],
        *[pick(other, c).alias("s_" + c) for c in ("longitude", "latitude")],
        (F.min("mmsi") == F.max("mmsi")).alias("same_mmsi"), F.bool_and("within_dynamic_radius").alias("all_in_radius"))
    g = g.where("n = 2")
    rep_pt = (F.col("r_longitude"), F.col("r_latitude"))
    sec_pt = (F.col("s_longitude"), F.col("s_latitude"))
    separation = geo.haversine_m(*rep_pt, *sec_pt)
    fraction = separation / F.col("r_length_m")
    alignment = geo.angular_difference(geo.bearing(*rep_pt, *sec_pt), F.col("r_effective_cog"))
    closeness = geo.haversine_m(*rep_pt, F.col("r_projected_longitude"), F.col("r_projected_latitude"))
    g = (g.withColumn("length_ok", fraction.between(params.minimum_length_fraction, params.maximum_length_fraction))
         .withColumn("aligned", alignment <= params.maximum_alignment_degrees)
         .withColumn("close", closeness <= params.maximum_representative_m)
         .withColumn("separation_m", F.round(separation, 1)).withColumn("alignment_deg", F.round(alignment, 2))
         .withColumn("representative_distance_m", F.round(closeness, 1)))
    return g.withColumn("all_passed", F.col("same_mmsi") & F.col("length_ok") & F.col("aligned") & F.col("close")
                        & F.col("all_in_radius")).select(
        key, "separation_m", "alignment_deg", "representative_distance_m", "same_mmsi", "length_ok", "aligned",
        "close", "all_in_radius", "all_passed")


def match_label(method: Column, same_mmsi: Column, plausible: Column, geometry_ok: Column, state: Column,
                within: Column, good: Column, distance: Column, size_ratio: Column, params: P.ReviewParams) -> Column:
    sized = size_ratio.between(params.minimum_size_ratio, params.maximum_size_ratio)
    fragment = (F.when(same_mmsi & plausible & geometry_ok, "HIGH").when(same_mmsi & plausible, "MEDIUM")
                .otherwise("LOW"))
    single = (F.when((state == "MATCHED") & within & good, "HIGH")
              .when((state == "POSSIBLE_MATCH") & good & (distance <= params.hard_maximum_m) & sized, "MEDIUM")
              .when(distance <= params.hard_maximum_m, "LOW").otherwise("NOT_ASSESSABLE"))
    return F.when(method == FRAGMENTS, fragment).otherwise(single)


def assemble_objects(members: DataFrame, params: P.ReviewParams = P.ReviewParams(), key: str = "object_id"
                     ) -> DataFrame:
    """Review objects with member ids and the three labels side by side."""
    per = members.groupBy(key).agg(
        F.count("*").alias("_n"), F.array_sort(F.collect_list("detection_id")).alias("detection_ids"),
        F.max(F.when(F.col("is_representative"), F.struct("mmsi", "match_state", "within_dynamic_radius", "projection_quality",
                                                          "distance_m", "span_m", "length_m"))).alias("lead"),
        (F.min("mmsi") == F.max("mmsi")).alias("same"), F.bool_and(F.col("distance_m") <= params.hard_maximum_m
                                                                   ).alias("plausible"))
    method = F.when(F.col("_n") == 2, FRAGMENTS).otherwise(SINGLE)
    checks = fragment_checks(members, params, key).select(key, "all_passed")
    out = per.join(quality_labels(members, params, key), key).join(checks, key, "left")
    lead = lambda c: F.col("lead")[c]
    label = match_label(method, F.coalesce("same", F.lit(False)), F.col("plausible"),
                        F.coalesce("all_passed", F.lit(False)), lead("match_state"), lead("within_dynamic_radius"),
                        lead("projection_quality").isin("HIGH", "MEDIUM"), lead("distance_m"),
                        lead("span_m") / lead("length_m"), params)
    return out.select(key, method.alias("grouping_method"), "member_count", "detection_ids",
                      lead("mmsi").alias("mmsi"), "detection_quality", "data_quality", label.alias("match_quality"))


def preserved_once(sources: DataFrame, objects: DataFrame, detection: str = "detection_id") -> DataFrame:
    """Violations: source ids missing from, or repeated over, the objects' member lists."""
    listed = objects.select(F.explode("detection_ids").alias(detection)).groupBy(detection).agg(
        F.count("*").alias("listed"))
    both = sources.select(detection).distinct().withColumn("_src", F.lit(True)).join(listed, detection, "full")
    return both.where(F.col("_src").isNull() | F.col("listed").isNull() | (F.col("listed") != 1))


def queue_summary(objects: DataFrame) -> DataFrame:
    count = lambda cond, n: F.count_if(cond).alias(n)
    out = objects.agg(
        F.sum("member_count").alias("source_candidates"), F.count("*").alias("review_objects"),
        count(F.col("grouping_method") == FRAGMENTS, "fragment_clusters"),
        count(F.col("grouping_method") == SINGLE, "single_candidates"),
        *[count(F.col(f"{d}_quality") == q, f"{d}_{q.lower()}") for d in ("detection", "data", "match")
          for q in ("HIGH", "MEDIUM", "LOW")])
    return out.withColumn("reduction", F.col("source_candidates") - F.col("review_objects"))


def projection_consistency(candidates: DataFrame, projections: DataFrame, key: str = "mmsi", limit_m: float = 2.0
                           ) -> DataFrame:
    """Joined rows whose two projected positions differ by more than ``limit_m`` are counted."""
    distance = geo.haversine_m(F.col("c.longitude"), F.col("c.latitude"), F.col("p.longitude"), F.col("p.latitude"))
    return candidates.alias("c").join(projections.alias("p"), F.col(f"c.{key}") == F.col(f"p.{key}")).agg(
        F.count("*").alias("compared"), F.count_if(distance > limit_m).alias("inconsistent"))
