"""Typed loaders for the driver tables (one parquet file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table.  Columns are pruned and filters pushed by Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(path(sf_dir, name))


def events_ltz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as a session-zone TIMESTAMP (watermarks reject NTZ)."""
    return load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
