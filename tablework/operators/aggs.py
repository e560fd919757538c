"""Aggregations.

Every keyed aggregate is a two-phase hash aggregate: partial results are
combined inside each task before the shuffle, so a key holding a third of
the rows ships one partial row per task.  Operators that build lists never
put a whole group in one row: lists come in bounded chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.common import col, r


def stats(df: DataFrame, c: str, population: bool = True, digits: int = 6) -> DataFrame:
    """count, mean, stdev, min, max, sum of one column (RDD ``stats()`` is
    population stdev; ``describe`` is sample)."""
    sd = F.stddev_pop if population else F.stddev_samp
    return df.agg(F.count(c).alias("count"), r(F.avg(c), digits).alias("mean"),
                  r(sd(c), digits).alias("stdev"), F.min(c).alias("min"),
                  F.max(c).alias("max"), r(F.sum(c), digits).alias("sum"))


def describe(df: DataFrame, c: str, digits: int = 4) -> DataFrame:
    """``describe(c)`` as (summary, value) with numeric values (sample stdev)."""
    a = df.agg(F.count(c).cast("double").alias("count"), r(F.avg(c), digits).alias("mean"),
               r(F.stddev_samp(c), digits).alias("stddev"),
               F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    return a.unpivot([], ["count", "mean", "stddev", "min", "max"], "summary", "value")


def by_key(df: DataFrame, keys: list[str | Column], aggs: dict[str, Column]) -> DataFrame:
    """``reduceByKey`` / ``groupByKey().map(sum)`` / ``countByKey`` → one plan."""
    return df.groupBy(*keys).agg(*[e.alias(n) for n, e in aggs.items()])


def reduce_by_key(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(out))


def mean_by_key(df: DataFrame, key: str, value: str, out: str = "mean", digits: int = 6) -> DataFrame:
    return df.groupBy(key).agg(r(F.avg(value), digits).alias(out))


def count_by(df: DataFrame, *keys: str, out: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_if_many(df: DataFrame, conds: dict[str, Column]) -> DataFrame:
    """Several conditional counts in one scan."""
    return df.agg(*[F.count_if(c).alias(n) for n, c in conds.items()])


def pair_counts(df: DataFrame, a: str, b: str, out: str = "count") -> DataFrame:
    """Pair-wise frequencies in long form (``a``, ``b``, count): any number of categories."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias(out))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pair-wise frequency table; first column ``{a}_{b}``, missing pairs 0.

    The columns are all values of ``b`` in the data (Spark raises beyond
    ``spark.sql.pivotMaxValues``; use ``pair_counts`` there)."""
    t = df.groupBy(a).pivot(b).agg(F.count(F.lit(1)))
    t = t.fillna(0, subset=[c for c in t.columns if c != a])
    return t.withColumnRenamed(a, f"{a}_{b}").withColumn(f"{a}_{b}", F.col(f"{a}_{b}").cast("string"))


def pivot_mean(df: DataFrame, row: str, column: str, value: str, digits: int = 4) -> DataFrame:
    """Mean of ``value`` for each ``row``, one column for each value of ``column`` in the data."""
    return df.groupBy(row).pivot(column).agg(r(F.avg(value), digits))


def group_lists(df: DataFrame, keys: list[str], value: str, order: list[str] | None = None,
                chunk: int = 1000, out: str = "items") -> DataFrame:
    """``groupBy(f)`` into sorted lists, in chunks of at most ``chunk`` items.

    The position of each value inside its group comes from a global
    numbering (``ordered_index``) minus the group's first position, so a hot
    group is spread over many tasks and no list grows with the data.
    ``keys`` and ``order`` together must name a row uniquely.  Output: keys,
    ``chunk`` number, ``n`` and the list.
    """
    from .splits import ordered_index

    order = order or [value]
    cols = list(dict.fromkeys([*keys, *order, value]))
    idx = ordered_index(df.select(*cols), [*keys, *order], "_i")  # staged
    start = idx.groupBy(*keys).agg(F.min("_i").alias("_s"))
    pos = idx.join(start, keys).withColumn("chunk", ((F.col("_i") - F.col("_s")) / chunk).cast("long"))
    return (pos.groupBy(*keys, "chunk")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array_sort(F.collect_list(F.col(value))).alias(out)))


def observed(df: DataFrame, name: str, metrics: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """Accumulator-style side metrics computed during the first action on the
    returned frame (``Observation.get`` afterwards).

    Caveat (Spark 4.1): once a session has used ``observe``, fitting ML
    models that keep a training summary in that session fails to serialise;
    call this on a frame of a separate ``spark.newSession()`` if the same
    application also trains models.
    """
    obs = Observation(name)
    return df.observe(obs, *[e.alias(n) for n, e in metrics.items()]), obs


def distinct(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def count_distinct(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Distinct counts of several columns, each as an aggregate of its own
    (no row is multiplied by the number of columns), side by side in one row."""
    res = None
    for name, c in cols.items():
        n = df.select(col(c).alias("_v")).distinct().agg(F.count("_v").alias(name)).withColumn("_k", F.lit(1))
        res = n if res is None else res.join(n, "_k")
    return res.drop("_k")
