"""Common-watermark snapshot: every vessel's position at one time all sources cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import params as P
from wakeline.operators import matching, snapshot


def build(positions: DataFrame, coverage: DataFrame, classified: DataFrame, seq: str,
          params: P.SnapshotParams = P.SnapshotParams()) -> tuple[DataFrame, DataFrame]:
    """(snapshot rows, readiness per source). Positions carry provider, identity_key, observed_at."""
    at = snapshot.common_watermark(positions, "observed_at", slow=params.slow_source).scalar()
    chosen = snapshot.pick_as_of(positions, at, snapshot.max_age(params), "observed_at", seq)
    rows = matching.enrich(snapshot.canonical(chosen, params=params), matching.classification_index(classified))
    ready = snapshot.coverage_state(coverage, chosen, at, params)
    return rows.withColumn("snapshot_at", at), ready.withColumn("ready", snapshot.is_ready(F.col("state")))
