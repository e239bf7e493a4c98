"""The registered queries of the library: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from importlib import import_module

MODULES = ("stat_queries", "name_queries", "quad_queries", "graph_queries", "stream_queries")


def queries() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"tessera.plans.{name}").QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"tessera.plans.{name}").SQL
    return out
