"""Name -> (Spark query, DuckDB oracle SQL).

Each registered callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole test tables.  The oracle text names derived views
(``logs``, ``spans`` ...) which ``with_views`` inlines as CTEs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skylight.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}

_MODULES = (
    "skylight.plans.q_traces",
    "skylight.plans.q_logs",
    "skylight.plans.q_metrics",
    "skylight.plans.q_alerts",
    "skylight.plans.q_ingest",
    "skylight.plans.q_governance",
    "skylight.plans.q_streaming",
)


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = with_views(oracle)
        return fn
    return deco


def _load() -> None:
    for mod in _MODULES:
        importlib.import_module(mod)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
