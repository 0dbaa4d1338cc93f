"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
driver tables and runs one operator (or a composition) from the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its DuckDB oracle (None → rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import q_sales, q_features, q_explore, q_monitor, q_store, q_learn, q_stream  # noqa: F401
