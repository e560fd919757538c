"""Comparing the rows of a bucket with each other when some buckets are very large."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def in_blocks(rows: DataFrame, key: str, salt: str, size: int) -> DataFrame:
    """Add ``gid`` and ``side``; each pair of rows that share ``key`` is to be compared under one ``gid``.

    A bucket of up to ``size`` rows is one group of side 0, all of whose pairs count.  A
    larger one is dealt by a hash of ``salt`` into parts of about ``size`` rows.  Each part
    is a group of side 0, and each two parts are a group with the sides 1 and 2, in which
    the pairs between the sides count; so no group grows with its bucket.
    """
    count = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size)
    hot = staged(count.select(F.col(key).alias("hot"), F.ceil(F.col("n") / size).cast("int").alias("g")), "hot-buckets")
    if hot.limit(1).count() == 0:
        return rows.withColumn("gid", F.col(key)).withColumn("side", F.lit(0))
    g = F.coalesce("g", F.lit(1))
    own = F.pmod(F.xxhash64(salt, F.lit(1)), g.cast("long")).cast("int")
    groups = F.transform(F.sequence(F.lit(0), g - 1), lambda other: F.struct(
        F.when(g == 1, F.col(key)).otherwise(F.xxhash64(F.col(key), F.least(own, other), F.greatest(own, other))).alias("gid"),
        F.when(own == other, 0).when(own < other, 1).otherwise(2).alias("side")))
    return (rows.join(hot, F.col(key) == F.col("hot"), "left").withColumn("to", F.explode(groups))
            .select(*[F.col(c) for c in rows.columns], "to.gid", "to.side"))


def grouped_batches(batches: Iterator[pa.RecordBatch], column: str = "gid") -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``column``, cut so that no group lies in two."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(batch.schema.get_field_index(column)).to_numpy()
        first = int(np.searchsorted(ids, ids[-1], side="left"))  # of the last group, which may go on
        if kept and ids[0] != _last(kept, column):
            yield _joined(kept)
            kept = []
        if first:
            yield _joined(kept + [batch.slice(0, first)])
            kept = []
        kept.append(batch.slice(first))
    if kept:
        yield _joined(kept)


def _last(kept: list[pa.RecordBatch], column: str):
    return kept[-1].column(kept[-1].schema.get_field_index(column))[-1].as_py()


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def spanning_links(group: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest over the values of each group that differ in at most ``distance`` bits.

    Compares each row with the row ``step`` further on, for every step that stays
    within some group; memory stays proportional to the rows.
    """
    root = np.arange(len(values))
    linked = False
    near: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for step in range(1, len(values)):
        same = np.flatnonzero(group[:-step] == group[step:])
        if not len(same):
            break
        close = same[np.bitwise_count(values[same] ^ values[same + step]) <= distance]
        close = close[root[close] != root[close + step]] if linked else close
        if len(close):
            near.append((close, close + step))
            held += len(close)
            if held > 4 * len(values):
                root, near, held, linked = merged(root, near), [], 0, True
    root = merged(root, near)
    moved = np.flatnonzero(root != np.arange(len(values)))
    a, b = values[moved], values[root[moved]]
    apart = a != b
    return a[apart], b[apart]


def merged(root: np.ndarray, near: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest row of each row's component after adding links to the forest ``root``."""
    if not near:
        return root
    a, b = (np.concatenate(x) for x in zip(*near))
    root = root.copy()
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        root = root[root]
        if np.array_equal(root, before):
            return root
