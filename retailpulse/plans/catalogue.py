"""Importing this module registers every query."""

from retailpulse.plans import report_queries, series_queries, tables_queries  # noqa: F401
from retailpulse.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
