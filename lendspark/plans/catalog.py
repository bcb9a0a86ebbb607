"""All registered queries."""

from . import catalog_clean, catalog_metrics, catalog_models, catalog_profile, catalog_segments, catalog_sources  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
