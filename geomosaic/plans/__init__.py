"""Registered queries with their SQL twins, and the catalog refreshes."""

from geomosaic.plans import (  # noqa: F401
    aggregating,
    filtering,
    joining,
    mosaicking,
    ordering,
    projecting,
    rastering,
    refreshing,
    scanning,
    serving,
    sinking,
    streams,
    timing,
    validating,
)
from geomosaic.plans.registry import ORACLES, QUERIES, oracle_text

__all__ = ["ORACLES", "QUERIES", "oracle_text"]
