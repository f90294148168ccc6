"""Registered queries with their SQL twins."""

from demandloom.catalog import (  # noqa: F401
    ensembles,
    evaluation,
    features,
    learners,
    quality,
    rollups,
    scoring,
    selection,
    staffing,
    streams,
    validation,
)
from demandloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
