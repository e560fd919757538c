"""Views and catalog tables."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def temp_view(df: DataFrame, name: str) -> str:
    """Session-scoped view (visible to ``spark.sql`` in this session)."""
    df.createOrReplaceTempView(name)
    return name


def global_view(df: DataFrame, name: str) -> str:
    """Application-scoped view, visible from every session as ``global_temp.name``."""
    df.createOrReplaceGlobalTempView(name)
    return f"global_temp.{name}"


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def refresh(spark: SparkSession, table: str) -> None:
    """Drop cached metadata/files of ``table`` after an outside change."""
    spark.catalog.refreshTable(table)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``persist`` for the duration of a block, then ``unpersist``."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
