"""All registered queries of the time-series engine and their DuckDB equivalents."""

from __future__ import annotations

from sparkcast.plans import queries_features, queries_models, queries_scoring, queries_silver, queries_sources, queries_streaming
from sparkcast.plans.register import ORACLE_SQL, QUERIES

MODULES = (queries_sources, queries_silver, queries_features, queries_scoring, queries_models, queries_streaming)
__all__ = ["MODULES", "ORACLE_SQL", "QUERIES"]
