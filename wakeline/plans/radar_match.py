"""Radar scene against the daily archive: detections, projected tracks, match states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.functions.records import record_score
from wakeline.operators import filters, radar, raster, snapshot


def detect(pixels: DataFrame, height: int, width: int, scene_tag: Column, params: P.CfarParams = P.CfarParams()
           ) -> DataFrame:
    """Numbered candidates of every scene in the pixel table."""
    hits = raster.guard_seeds(raster.compare_profiles(pixels, height, width, params), params)
    parts = raster.label_components(raster.union_seeds(hits, params), params.link_radius)
    return raster.number_candidates(raster.measure_components(parts, params=params), scene_tag, params)


def match(detections: DataFrame, archive: DataFrame, scene_at: Column, box: tuple, seq: str,
          params: P.MatchParams = P.MatchParams()) -> DataFrame:
    """Match state per detection, from typed archive records around the scene time."""
    near = archive.where(filters.in_scene_window(F.col("observed_at"), scene_at, params.window_minutes))
    gap = F.abs(F.unix_micros("observed_at") - F.unix_micros(scene_at)) / 3.6e9
    edges = [F.lit(float(v)) for v in box]
    inside = near.where(filters.inside_guard(F.col("longitude"), F.col("latitude"), *edges, F.col("sog"), gap, params))
    kept = snapshot.bracketing(inside, scene_at, "mmsi", "observed_at", record_score(archive.columns), seq,
                               params.per_side)
    tracks = radar.local_context(radar.project_tracks(kept, scene_at, params=params), *edges, params.local_padding_nm)
    start = scene_at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(params.window_minutes))
    bins = 2 * params.window_minutes // params.bin_minutes
    enough = radar.coverage_summary(near, start, bins, "observed_at", params).select("sufficient")
    return radar.match_states(detections, radar.candidate_pairs(detections, tracks, params), enough)
