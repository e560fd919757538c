"""User functions.

Built-in functions are always preferred; these are the escape hatches.
Python UDFs use Arrow batches (``useArrow=True`` / pandas UDFs), never
pickled row-at-a-time transfer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import stage


def _token_count(s: str | None) -> int | None:
    return None if s is None else len(s.split(" "))


@cache
def token_count():
    """Arrow-optimised scalar Python UDF (U01): tokens split on one space."""
    return F.udf(_token_count, "int", useArrow=True)


def _multiply(a: pd.Series, b: pd.Series) -> pd.Series:
    return a * b


@cache
def multiply():
    """Vectorised scalar UDF (U02): one call per Arrow batch."""
    return F.pandas_udf(_multiply, returnType=LongType())


def _add_length(s1: pd.Series, s2: pd.Series, s3: pd.DataFrame) -> pd.DataFrame:
    out = s3.copy()
    out["col2"] = s1 + s2.str.len()
    return out


@cache
def add_length():
    """Struct in / struct out (U03): ``col2 = s1 + len(s2)``, ``col1`` kept."""
    return F.pandas_udf(_add_length, "col1 string, col2 long")


def center_by_group(df: DataFrame, key: str | list[str], value: str, out: str | None = None) -> DataFrame:
    """Subtract the group mean from every value (U04 semantics).

    The means come from a two-phase aggregate and are joined back on the
    key; a hot key is handled by AQE's skew-join split, and no group is
    ever materialised in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    return df.join(means, keys).withColumn(out or value, F.col(value) - F.col("_mean")).drop("_mean")


def apply_grouped(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Grouped map with a pandas function (``applyInPandas``).

    Every group is handed to ``fn`` whole, so use it only for keys whose
    groups are bounded by construction; ``center_by_group`` shows the
    scalable form for aggregate-then-adjust logic.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema=schema)


def apply_grouped_batches(df: DataFrame, keys: list[str], fn, schema: str, parts: int = 1) -> DataFrame:
    """Grouped map over an iterator of batches: a group need not fit one frame.

    ``fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]`` sees a group's rows some thousands at a
    time (``spark.sql.execution.arrow.maxRecordsPerBatch``); the annotations tell Spark which form it is.  With ``parts``
    each group is dealt by a hash of its rows into so many, each given to ``fn`` apart, so that a key
    with a great share of the rows is several tasks' work; ``fn`` then yields partial results, and the caller adds
    them up by ``keys``.
    """
    if parts == 1:
        return df.groupBy(*keys).applyInPandas(fn, schema=schema)
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts))
    return df.groupBy(*keys, part.alias("_part")).applyInPandas(fn, schema=schema)


def line_sums(key: str, x: str, y: str, most: int = 100_000):
    """A grouped-map body for ``apply_grouped_batches``: what a straight line through each key's points needs.

    A group may hold many keys.  A batch is summed by key at once; sums of more than ``most`` rows are added up before more
    come, and given out as partial results if there are as many keys.
    """
    parts = ["n", "sx", "sy", "sxx", "sxy"]

    def added(frames: list[pd.DataFrame]) -> pd.DataFrame:
        sums = pd.concat(frames).groupby(key, dropna=False, sort=False)[parts].sum().reset_index()
        return sums.assign(**{key: sums[key].astype(object).where(sums[key].notna(), None)})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        for b in batches:
            if not len(b):
                continue
            u, v = b[x].astype(float), b[y].astype(float)
            waiting.append(added([pd.DataFrame({key: b[key], "n": 1.0, "sx": u, "sy": v, "sxx": u * u, "sxy": u * v})]))
            if sum(map(len, waiting)) > most:
                waiting = [added(waiting)]
                if len(waiting[0]) > most:
                    yield waiting.pop()
        if waiting:
            yield added(waiting)

    return fold


def fit_lines(df: DataFrame, key: str, x: str, y: str, parts: int = 8) -> DataFrame:
    """(``key``, n, slope, intercept) of the least-squares line of ``y`` over ``x`` in each group; no slope where x does not vary.

    Rows with a null x or y are left out.  A group of the map holds the keys of one bucket, so many small keys cost one call,
    not one each.
    """
    kind = df.schema[key].dataType.simpleString()
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bucket = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(buckets)))  # null keys apart: pandas has none among integers
    rows = df.select(key, x, y, bucket.alias("_bucket")).dropna(subset=[x, y])
    sums = apply_grouped_batches(rows, ["_bucket"], line_sums(key, x, y), f"`{key}` {kind}, n double, sx double, sy double, sxx double, sxy double", parts)
    total = sums.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread)
    return total.withColumn("slope", slope).select(
        key, F.col("n").cast("long").alias("n"), "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept"))


def subtract_mean(pdf: pd.DataFrame) -> pd.DataFrame:
    """pandas grouped-map body: ``v - mean(v)`` within the group."""
    return pdf.assign(v=pdf.v - pdf.v.mean())


def per_partition(df: DataFrame, action, schema: str) -> DataFrame:
    """Run ``action`` once per partition and keep what it reports.

    ``action`` gets an iterator over the partition's Arrow-backed pandas
    batches (open a connection or file before the loop, close it after) and
    yields report rows of ``schema``.  The report is written to the shared
    checkpoint folder by Spark's committer, which keeps one attempt of each
    task; an action with effects of its own must therefore be safe to repeat.
    """
    return stage(df.mapInPandas(action, schema), "per-partition")
