"""Vessel-tracking analytics on Spark: DataFrame in, DataFrame out, explicit ``as_of``."""

from wakeline.session import build_session

__all__ = ["build_session"]
