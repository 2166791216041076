"""
their DuckDB oracle SQL. ``__spark_entry__`` only lists this registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}
_LOADED = False


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the oracle (omitted for operators with no SQL form, e.g. model fits)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    global _LOADED
    if not _LOADED:
        _LOADED = True
        from delaylake.plans import q_chains, q_core, q_dashboard, q_features, q_io, q_models  # noqa: F401


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
