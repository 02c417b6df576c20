"""All queries of the library."""

from __future__ import annotations

from metrolith.plans import flow_queries, gate_queries, place_queries, schedule_queries, source_queries  # noqa: F401
from metrolith.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
