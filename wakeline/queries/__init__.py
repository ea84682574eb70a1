"""Every operator as a query over the given tables, most with a SQL check."""

from wakeline.queries import (  # noqa: F401
    q_filters,
    q_functions,
    q_history,
    q_matching,
    q_merge,
    q_radar,
    q_raster,
    q_snapshot,
    q_sources,
    q_spatial,
    q_streaming,
)
from wakeline.queries.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
