"""Registry of named queries.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
library's operators.  When the result is exactly expressible in SQL, the
registration also carries an oracle statement over the same tables (DuckDB
dialect, tables available as views).  Computed columns carry the same alias
on both sides; doubles are rounded identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` with an optional oracle SQL string."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco
