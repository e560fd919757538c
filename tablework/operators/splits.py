"""Row numbering and data splits.

``ordered_index`` gives every row its 0-based position in a total order
without funnelling the data through one task: rows are sorted by range in one
shuffle and staged with their number inside the range, then shifted by the row
count of all earlier ranges (a table with one row per range, so its broadcast
is bounded by the number of ranges).  Being written, the numbers agree however
often and with whatever columns the plan is evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


def _num_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, order: list[str | Column], partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """``df`` sorted by range and staged, with ``_range`` and the place ``_pos`` in it, and the rows of each range.

    A task numbers the rows that it has sorted as it writes them; from then on the numbers are data.
    """
    n = partitions or _num_partitions(df)
    placed = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_m", F.monotonically_increasing_id()))
    # a row's number has its partition above the lower 33 bits and its place in it below
    rows = stage(placed, "ranged").withColumn("_range", F.shiftright("_m", 33)) \
        .withColumn("_pos", F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m")
    return rows, rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_cnt"))


def ordered_index(df: DataFrame, order: list[str | Column], out: str = "idx", partitions: int | None = None,
                  with_total: str | None = None) -> DataFrame:
    """Append ``out`` = 0-based rank of each row in ``order`` (names ascending, nulls first; columns as they say).

    ``order`` must be a total order (unique key) for the result to be
    deterministic.  With ``with_total`` the total row count is added too.
    All other columns of ``df`` are carried along.
    """
    local, counts = _ranged(df, order, partitions)
    w = Window.orderBy("_range")  # one row for each range
    offsets = counts.select(
        "_range",
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_off"),
        F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_total"))
    res = local.join(F.broadcast(offsets), "_range").withColumn(out, F.col("_off") + F.col("_pos"))
    if with_total:
        res = res.withColumn(with_total, F.col("_total"))
    return res.drop("_range", "_pos", "_off", "_total")


def running_sum(df: DataFrame, key: str, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Append ``out`` = sum of ``value`` over all rows with a smaller ``key`` (unique), 0 for the first."""
    rows, _ = _ranged(df, [key], partitions)
    w = Window.partitionBy("_range").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_loc", F.coalesce(F.sum(value).over(w), F.lit(0)))
    totals = rows.groupBy("_range").agg(F.sum(value).alias("_t"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = totals.select("_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_range").withColumn(out, F.col("_off") + F.col("_loc"))
            .drop("_range", "_loc", "_off", "_pos"))


def random_split(df: DataFrame, weights: list[float], seed: int | None = None,
                 out: str = "split") -> DataFrame:
    """Random weighted split in one pass: a seeded number per row, labelled by
    the range of cumulated weights it falls into (split number in ``out``)."""
    total = float(sum(weights))
    bounds = [sum(weights[:i + 1]) / total for i in range(len(weights) - 1)]
    draw = F.rand(seed) if seed is not None else F.rand()
    drawn = df.withColumn("_draw", draw)
    label = F.lit(len(weights) - 1)
    for i, hi in reversed(list(enumerate(bounds))):
        label = F.when(F.col("_draw") < hi, F.lit(i)).otherwise(label)
    return drawn.withColumn(out, label).drop("_draw")


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Reproducible bucket of an integer key: a multiplicative hash that any
    SQL engine can evaluate, so a split is stable across partitionings,
    reruns and engines.

    The product with the multiplier is taken modulo 2^32 by halves of the key, so
    that it fits 64 bits whatever the key."""
    k = F.col(key) if isinstance(key, str) else key
    key32, span, factor = F.pmod(k.cast("long"), F.lit(1 << 32)), F.lit(1 << 32), F.lit(2654435761)
    high = F.pmod(F.shiftright(key32, 16) * factor, span) * F.lit(1 << 16)
    low = key32.bitwiseAND(F.lit((1 << 16) - 1)) * factor
    return F.pmod(F.pmod(high + low + F.lit(12345), span), F.lit(buckets)).cast("int")


def hash_split(df: DataFrame, key: str, weights: list[float], out: str = "split",
               buckets: int = 100) -> DataFrame:
    """Deterministic weighted split by key bucket (no sampling state)."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        acc += w
        bounds.append(int(round(acc / total * buckets)))
    b = hash_bucket(key, buckets)
    expr = None
    for i, hi in reversed(list(enumerate(bounds))):
        expr = F.when(b < hi, F.lit(i)) if expr is None else F.when(b < hi, F.lit(i)).otherwise(expr)
    return df.withColumn(out, expr)


def kfold(df: DataFrame, order: list[str], k: int, out: str = "fold") -> DataFrame:
    """Contiguous k-fold slices of a stable order: fold = floor(idx*k/n)."""
    idx = ordered_index(df, order, "_idx", with_total="_n")
    return idx.withColumn(out, F.floor(F.col("_idx") * k / F.col("_n")).cast("int")).drop("_idx", "_n")


def leave_n_out(df: DataFrame, user: str, order: list[str], key: list[str],
                start: int, stop: int, out: str = "is_test") -> DataFrame:
    """Mark each user's ratings number ``start..stop`` (in ``order``, ties by ``key``) as test.

    The input is staged once on shared storage.  Only the first ``stop`` rows
    per user are ranked: Spark's group-limit pushes a partial top-``stop``
    below the shuffle, so even a user owning a third of all rows costs
    ``stop`` rows per task in the exchange.  What is joined to the staged rows
    is one row per user, its first and last test row; a rating between them
    is marked.
    """
    rows = stage(df, "leave-n-out")
    full = list(dict.fromkeys([*order, *key]))
    at = F.struct(*full)
    w = Window.partitionBy(user).orderBy(*full)
    bounds = (rows.select(user, *[c for c in full if c != user])
              .withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") <= stop)
              .filter(F.col("_rn") >= start)
              .groupBy(F.col(user).alias("_user")).agg(F.min(at).alias("_low"), F.max(at).alias("_high")))
    between = (at >= F.col("_low")) & (at <= F.col("_high"))
    return (rows.join(bounds, F.col(user).eqNullSafe(F.col("_user")), "left")
            .withColumn(out, F.coalesce(between, F.lit(False))).drop("_user", "_low", "_high"))
