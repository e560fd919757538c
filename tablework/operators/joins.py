"""Joins (J01-J12) and set operations.

Join strategy is left to Catalyst/AQE: sort-merge for big × big, broadcast
when the statistics or the runtime size are under the byte threshold, split
partitions for skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join(a: DataFrame, b: DataFrame, on, how: str = "inner") -> DataFrame:
    """``how``: inner, left, right, full, left_anti, left_semi."""
    return a.join(b, on=on, how=how)


def enrich(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Look-up of ``dim`` attributes (the broadcast-variable pattern).

    Spark ships ``dim`` to the executors when its size in bytes is under
    ``spark.sql.autoBroadcastJoinThreshold``, by statistics or as measured at
    run time, and shuffles otherwise.
    """
    return df.join(dim, on=on, how=how)


def subtract(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """RDD ``subtract``: rows of ``a`` not in ``b``, keeping ``a``'s
    duplicates (null-safe), unlike ``except`` (distinct) or ``exceptAll``."""
    cols = cols or a.columns
    bb = b.select(*[F.col(c).alias(f"_b_{c}") for c in cols]).distinct()
    cond = reduce(lambda x, y: x & y, [a[c].eqNullSafe(bb[f"_b_{c}"]) for c in cols])
    return a.join(bb, cond, "left_anti")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Bag union of n inputs by column name."""
    return reduce(lambda x, y: x.unionByName(y), dfs)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct intersection."""
    return a.intersect(b)


def tag_sides(a: DataFrame, b: DataFrame, key: str, va: str, vb: str,
              side: str = "side", value: str = "v") -> DataFrame:
    """Both inputs as one ``(key, side, value)`` table (cogroup input)."""
    return (a.select(F.col(key), F.lit("left").alias(side), F.col(va).alias(value))
            .unionByName(b.select(F.col(key), F.lit("right").alias(side), F.col(vb).alias(value))))


def cogroup(a: DataFrame, b: DataFrame, key: str, va: str, vb: str, chunk: int = 1000) -> DataFrame:
    """``cogroup``: for every key, the values from each side as sorted lists.

    Lists come in chunks of at most ``chunk`` (see ``aggs.group_lists``);
    a key present on one side only gets lists for that side only.
    """
    from .aggs import group_lists

    return group_lists(tag_sides(a, b, key, va, vb), [key, "side"], "v", chunk=chunk)
