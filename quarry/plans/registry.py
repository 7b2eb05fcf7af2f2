"""Query registry: name -> (spark, sf_dir) -> DataFrame, plus DuckDB twins.

Every registered query reads the given tables (whole tables) and aliases
every computed column identically in Spark and in its SQL twin.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "quarry.plans.q_profile",
    "quarry.plans.q_columns",
    "quarry.plans.q_split",
    "quarry.plans.q_joins",
    "quarry.plans.q_aggregate",
    "quarry.plans.q_window",
    "quarry.plans.q_features",
    "quarry.plans.q_arrays",
    "quarry.plans.q_text",
    "quarry.plans.q_math",
    "quarry.plans.q_metrics",
    "quarry.plans.q_models",
    "quarry.plans.q_cluster",
    "quarry.plans.q_reduce",
    "quarry.plans.q_stream",
    "quarry.plans.regression",
)


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load():
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise


def all_queries() -> dict[str, Callable]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
