"""Vector code compression: product codes with integer k-means and pivot bounds (LAESA).

A vector is cut into equal parts; a part's code is the number of the nearest entry of its
position's codebook.  All arithmetic that decides is on integers.

Distances of every part to a few fixed pivots (its position's first entries) are computed once
and staged with the parts.  In a round, the entries' distances to the pivots give, by the triangle
inequality, a lower bound for each part and entry.  Entries are taken in the order of their bounds; one
whose bound is above the best exact distance so far is never evaluated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, others, staged

#: Components become floor(SCALE * x); beyond LIMIT their squared distances would leave 64 bits.
SCALE, LIMIT = 4096, 1 << 27

#: Rows worked on at a time.
ROWS = 8192


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, along the last axis."""
    return ((x - y) ** 2).sum(-1)


def nearest(parts: np.ndarray, to_pivot: np.ndarray, entries: np.ndarray, entry_to_pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of each part's nearest entry (ties: the lower number), and how many were evaluated.

    ``parts`` (n, d) and ``entries`` (k, d) are integers; ``to_pivot`` (n, p) and ``entry_to_pivot`` (k, p) are
    their distances to the pivots, square roots rounded to doubles.
    """
    n, k = len(parts), len(entries)
    bound = np.zeros((n, k))
    for p in range(to_pivot.shape[1]):
        np.maximum(bound, np.abs(to_pivot[:, p, None] - entry_to_pivot[None, :, p]), out=bound)
    # below the true distance also after rounding: a distance below 2**30 is off by less than 2**-22
    bound = np.maximum(bound - 1e-6, 0.0) ** 2 * (1 - 1e-12)
    order = np.argsort(bound, axis=1, kind="stable")
    best, code, evaluated = np.full(n, np.iinfo(np.int64).max), np.full(n, k), 0
    for j in range(k):
        entry = order[:, j]
        open_ = np.flatnonzero(bound[np.arange(n), entry] <= best)
        if not len(open_):
            break
        e = entry[open_]
        d = distances(parts[open_], entries[e])
        evaluated += len(open_)
        better = (d < best[open_]) | ((d == best[open_]) & (e < code[open_]))
        best[open_[better]], code[open_[better]] = d[better], e[better]
    return code, best, evaluated


class Codebooks:
    """The entries of every position (positions, entries, width) with their distances to the pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots
        self.to_pivot = np.sqrt(distances(entries[:, :, None, :], pivots[:, None, :, :]).astype(np.float64))

    def codes(self, ints: np.ndarray, to_pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(n, positions) codes and squared distances of (n, positions, width) parts."""
        found = [nearest(ints[:, i], to_pivot[:, i], self.entries[i], self.to_pivot[i]) for i in range(len(self.entries))]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1), sum(f[2] for f in found)


def _array(batch: pa.RecordBatch, column: str, kind) -> np.ndarray:
    """A column of lists of the same length as an array of rows."""
    c = batch.column(batch.schema.get_field_index(column))
    return c.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(batch.num_rows, -1)


def _blocks(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def kept_vectors(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is not null and holds finite numbers only."""
    v = F.col(f"`{vector}`")
    return df.filter(v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 8,
             entries: int = 16, rounds: int = 6, pivots: int = 4) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the final codebooks (parts, entries, width).

    Rows whose vector is null or holds null or non-finite components are dropped.  The result has the other
    columns of ``df`` and code (string: two hexadecimal digits for each part), error (long: squared distances to the
    chosen entries, summed) and label_error (long: errors summed over the rows with an equal ``label``, nulls together).

    The codebooks start as the parts of the vectors with the ``entries`` smallest keys, ascending, null keys last,
    vectors of the same key by their components; with fewer vectors they have fewer entries.  Each of ``rounds``
    rounds assigns every part to the nearest entry, ties to the lower number, and moves an entry to the floor of
    its parts' mean; an entry without parts stays.  Vectors have to have the same length, a multiple of ``parts``, and
    components below 2**15 in magnitude, else a ValueError says so; an empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits for each part: 256 entries at most")
    spark = df.sparkSession
    ints_, piv_, id_ = free_name(df, "ints_"), free_name(df, "to_pivot_"), free_name(df, "row_key_")
    v = F.col(f"`{vector}`")
    sound = kept_vectors(df, vector)
    shape = sound.agg(F.min(F.size(v)).alias("low"), F.max(F.size(v)).alias("high"),
                      F.max(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    kept = others(df, ["code", "error", "label_error"])
    kind = T.StructType([*[df.schema[c] for c in kept], T.StructField("code", T.StringType()),
                         T.StructField("error", T.LongType()), T.StructField("label_error", T.LongType())])
    if shape["low"] is None:
        return spark.createDataFrame([], kind), np.zeros((parts, 0, 0), np.int64)
    if shape["low"] != shape["high"] or shape["low"] % parts:
        raise ValueError(f"vectors have {shape['low']} to {shape['high']} components, not one multiple of {parts}")
    if shape["most"] is not None and shape["most"] * SCALE >= LIMIT:
        raise ValueError(f"a component of magnitude {shape['most']} is not below {LIMIT // SCALE}")
    width = shape["low"] // parts
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * SCALE))
    rows = sound.withColumn(ints_, ints)
    firsts = rows.select(F.col(f"`{key}`").alias("k"), F.col(ints_).alias("v")).orderBy(F.col("k").asc_nulls_last(), "v").limit(entries)
    first = np.array([r["v"] for r in firsts.collect()], np.int64).reshape(-1, parts, width).transpose(1, 0, 2)
    if not width:
        first = np.zeros((parts, len(first[0]) if first.size else 1, 0), np.int64)
    fixed = first[:, :pivots]
    schema = T.StructType([*rows.schema.fields, T.StructField(piv_, T.ArrayType(T.DoubleType()))])

    def to_pivots(batches):
        for b in _blocks(batches):
            x = _array(b, ints_, np.int64).reshape(-1, parts, width)
            d = np.sqrt(distances(x[:, :, None, :], fixed[None]).astype(np.float64)).reshape(len(x), -1)
            yield pa.RecordBatch.from_arrays([*b.columns, _lists(d, pa.float64())], names=schema.names)

    table = staged(rows.mapInArrow(to_pivots, schema), "vector-parts")
    books = Codebooks(first, fixed)
    for _ in range(rounds):
        books = Codebooks(_moved(table, books, ints_, piv_), fixed)
    final = books

    def assign(batches):
        for b in _blocks(batches):
            x = _array(b, ints_, np.int64).reshape(-1, parts, width)
            code, d, _ = final.codes(x, _array(b, piv_, np.float64).reshape(len(x), parts, -1))
            text = [row.tobytes().hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(c)) for c in kept], pa.array(text), pa.array(d.sum(1))],
                                             names=[*kept, "code", "error"])

    coded = table.select(*[F.col(f"`{c}`") for c in [*kept, ints_, piv_]]).mapInArrow(
        assign, T.StructType(kind.fields[:-1]))
    coded = staged(coded, "vector-codes")
    mark = free_name(df, "label_key_")
    total = staged(coded.groupBy(F.col(f"`{label}`").alias(mark)).agg(F.sum("error").alias("label_error")), "vector-labels")
    done = coded.join(total, F.col(f"`{label}`").eqNullSafe(F.col(mark))).select(*[F.col(f"`{c}`") for c in kept], "code", "error", "label_error")
    return done, final.entries


def _lists(rows: np.ndarray, kind) -> pa.Array:
    n, m = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * m, pa.int32()), pa.array(rows.ravel(), kind))


def _moved(table: DataFrame, books: Codebooks, ints: str, to_pivot: str) -> np.ndarray:
    """The entries at the floors of their parts' means; a task sends one row for each entry in use."""
    positions, k, width = books.entries.shape

    def sums(batches):
        count, total = np.zeros((positions, k), np.int64), np.zeros((positions, k, width), np.int64)
        for b in _blocks(batches):
            x = _array(b, ints, np.int64).reshape(-1, positions, width)
            code, _, _ = books.codes(x, _array(b, to_pivot, np.float64).reshape(len(x), positions, -1))
            for i in range(positions):
                count[i] += np.bincount(code[:, i], minlength=k)
                order = np.argsort(code[:, i], kind="stable")
                used, at = np.unique(code[order, i], return_index=True)
                total[i, used] += np.add.reduceat(x[order, i], at)
        i, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(e), pa.array(count[i, e]), _lists(total[i, e], pa.int64())],
                                         names=["part", "entry", "n", "total"])

    got = table.select(ints, to_pivot).mapInArrow(sums, "part long, entry long, n long, total array<long>")
    got = got.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(j))).alias(f"s{j}") for j in range(width)])
    moved = books.entries.copy()
    for r in got.collect():  # positions times entries rows, whatever the input
        moved[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(width)]
    return moved


def sha256(entries: np.ndarray) -> str:
    """Of all integers by part, entry and position within the part, joined by commas."""
    return hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()
