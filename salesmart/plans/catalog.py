"""Registry of named queries and their DuckDB oracle SQL.

Each query is a function ``(spark, sf_dir) -> DataFrame``; its oracle is an
independent SQL statement over the same tables, written next to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its oracle (omit when no SQL form exists)."""

    def register(fn: QueryFn) -> QueryFn:
        # Re-registration (a module reloaded by its caller) replaces the entry.
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from salesmart.plans import (  # noqa: F401
        ingest_queries,
        join_queries,
        profile_queries,
        sales_queries,
        scd2_queries,
        table_queries,
    )
