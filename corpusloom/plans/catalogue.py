"""Registered queries of the engine's own operators, each with its DuckDB counterpart."""

from __future__ import annotations

from corpusloom.plans import queries_flow, queries_load, queries_search, queries_store, queries_text

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
for _module in (queries_search, queries_store, queries_load, queries_text, queries_flow):
    QUERIES |= _module.REGISTRY.queries
    ORACLE_SQL |= _module.REGISTRY.sql
