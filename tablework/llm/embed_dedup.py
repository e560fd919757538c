"""Embedding near-duplicates by randomised-rotation binary codes.

A unit vector is rotated at random; the signs of the result are its binary code, and the
inner product of code and vector is stored as the code's correction factor.  For
another unit vector, (code . other) / factor estimates the cosine without bias over
the rotation, and what the code leaves out bounds the estimate's error: a vector
at an angle a from the coded one is estimated within
sin(a) * sqrt(1 - factor^2) / factor of its cosine.  Pairs whose estimate falls below
the threshold by more than that bound cannot be links; all others are recomputed
exactly in double precision.

Candidates come from tables of a few signs under rotations of their own.  Their number
follows from the size of the largest label and a documented chance to miss a pair
that lies right at the threshold.  Equal vectors are one vector from the start.  A
pair is judged in the first table where it meets, large buckets in blocks of bounded
size; blocks return counts and the links of a spanning forest, not pairs.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import grouped_batches, in_blocks, merged
from .common import shuffle_partitions, staged
from .components import components


def tables_for(rows: int, threshold: float, miss: float, bucket: int = 512) -> tuple[int, int]:
    """Signs in a key and number of tables: buckets of about ``bucket`` rows, at most ``miss`` chance to miss a pair."""
    agree = 1 - acos(threshold) / pi
    signs = max(1, min(24, ceil(log2(max(2, rows / bucket)))))
    return signs, max(1, ceil(log(miss) / log(1 - agree ** signs)))


def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def table_keys(unit: np.ndarray, signs: int, tables: int, seed: int) -> np.ndarray:
    """Key of each vector in each table, from the rows of further rotations."""
    dim = unit.shape[1]
    need = signs * tables
    rows = np.concatenate([rotation(dim, seed + 1 + i) for i in range(-(-need // dim))])[:need]
    bits = (unit @ rows.T > 0).reshape(len(unit), tables, signs)
    return bits @ (1 << np.arange(signs))


def near_links(x: np.ndarray, threshold: float, keys: np.ndarray, table: int, left: np.ndarray, right: np.ndarray,
               seed: int, stats: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (one of ``left``, one of ``right``) with cosine at least ``threshold`` that share no earlier table's key.

    With ``left is right`` each pair is given once.
    """
    size = np.abs(x).max(1)
    odd = (size > 1e100) | (size < 1e-100)  # squares would leave the range; a power of two changes no digit
    if odd.any():
        x = x.copy()
        x[odd] = np.ldexp(x[odd], -np.frexp(size[odd])[1][:, None])
    norm = np.sqrt((x * x).sum(1))
    unit = x / norm[:, None]
    dim = x.shape[1]
    turned = unit @ rotation(dim, seed).T
    code = np.where(turned > 0, 1.0, -1.0) / np.sqrt(dim)
    factor = (code * turned).sum(1)
    # no vector at the threshold or nearer is estimated below this
    floor = threshold - np.sqrt(1 - threshold ** 2) * np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor - 1e-5
    found_a, found_b = [], []
    code32, turned32 = code.astype(np.float32), turned.astype(np.float32)
    for i in range(0, len(left), 512):
        a = left[i:i + 512]
        estimate = (code32[a] @ turned32[right].T) / factor[a, None].astype(np.float32)
        p, q = np.nonzero(estimate >= floor[a, None])
        p, q = a[p], right[q]
        if left is right:
            p, q = p[p < q], q[p < q]
        for j in range(0, len(p), 65_536):
            u, v = p[j:j + 65_536], q[j:j + 65_536]
            fresh = ~(keys[u, :table] == keys[v, :table]).any(1) if table else np.ones(len(u), bool)
            u, v = u[fresh], v[fresh]
            cosine = (x[u] * x[v]).sum(1) / (norm[u] * norm[v])
            if stats is not None:
                stats["exact"] = stats.get("exact", 0) + len(u)
            link = cosine >= threshold
            found_a.append(u[link])
            found_b.append(v[link])
        if stats is not None:
            stats["pairs"] = stats.get("pairs", 0) + estimate.size
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.98, miss: float = 1e-6, block: int = 2048, seed: int = 3) -> DataFrame:
    """One row per input row: ``key``, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null, and linked if their
    cosine in double precision is at least ``threshold``.  Vectors that are null, zero,
    or hold a null or non-finite component, and rows without a label or key, link with
    nothing.  ``n_links`` counts the other rows linked directly (copies included),
    ``component_id`` is the smallest key reachable, ``kept`` tells whether it is the row's own.
    Vectors of different lengths are never linked.  A pair right at the threshold is
    missed with a chance of at most ``miss``, nearer pairs with less; pairs below the
    threshold are never linked.  Rows that repeat a key are one node of the link graph.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").alias("id_"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                     F.col(f"`{label}`").alias("label_"))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    usable = F.col("id_").isNotNull() & F.col("label_").isNotNull() & F.col("v").isNotNull()
    usable = F.coalesce(usable & finite & F.exists("v", lambda e: e != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(usable, F.col("v"))).withColumn("label_", F.when(usable, F.col("label_")))
    one = staged(rows.filter("v is not null").groupBy("label_", "v")
                 .agg(F.min("id_").alias("rep"), F.count(F.lit(1)).alias("copies")), "vectors")
    largest = one.groupBy("label_").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).collect()[0][0] or 0
    signs, tables = tables_for(largest, threshold, miss)

    def keyed(batches):
        for batch in batches:
            col = batch.column(batch.schema.get_field_index("v"))
            sizes = np.diff(col.offsets.to_numpy())
            out = [None] * len(sizes)
            for dim in set(sizes.tolist()):
                at = np.flatnonzero(sizes == dim)
                x = np.array([col[int(i)].values.to_numpy() for i in at])
                x = x / np.abs(x).max(1)[:, None]  # so that no square overflows
                for i, keys in zip(at, table_keys(x, signs, tables, seed)):
                    out[i] = keys.tolist()
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(out, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "tables"])

    coded = one.mapInArrow(keyed, f"label_ {one.schema['label_'].dataType.simpleString()}, v array<double>, "
                           f"rep {one.schema['rep'].dataType.simpleString()}, copies long, tables array<bigint>")
    met = coded.select("label_", "v", "rep", "copies", "tables", F.posexplode("tables").alias("t", "k")).withColumn(
        "bucket", F.xxhash64("t", "k", "label_", F.size("v")))
    met = in_blocks(staged(met, "vector-tables"), "bucket", "rep", block)

    def compare(batches):
        for batch in grouped_batches(batches):
            gid = batch.column("gid").to_numpy()
            edges = np.flatnonzero(np.diff(gid)) + 1
            out = {"rep": [], "other": [], "n": []}
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(gid)]):
                if b - a > 1:
                    _compare_group(batch.slice(a, b - a), threshold, seed, out)
            yield pa.RecordBatch.from_arrays([pa.array(out["rep"], batch.schema.field("rep").type),
                                              pa.array(out["other"], batch.schema.field("rep").type),
                                              pa.array(out["n"], pa.int64())], names=["rep", "other", "n"])

    kind = one.schema["rep"].dataType.simpleString()
    compared = staged(met.select("gid", "rep", "copies", "t", "label_", "v", "tables", "bucket", "side")
                      .repartition(shuffle_partitions(spark), "gid").sortWithinPartitions("gid", "rep")
                      .mapInArrow(compare, f"rep {kind}, other {kind}, n long"), "vector-links")
    roots = components(staged(compared.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")),
                              "vector-forest"), "vector-components")
    linked = compared.filter("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    per_vector = staged(one.join(linked, "rep", "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
                        .select(F.col("label_").alias("l"), F.col("v").alias("w"), "copies", "n",
                                F.coalesce("root", "rep").alias("root")), "vector-results")
    return (rows.join(per_vector, (F.col("label_") == F.col("l")) & (F.col("v") == F.col("w")), "left")
            .select(F.col("id_").alias(key),
                    F.coalesce(F.col("copies") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).alias("n_links"),
                    F.coalesce("root", "id_").alias("component_id"),
                    F.coalesce(F.col("id_") == F.coalesce("root", "id_"), F.lit(False)).alias("kept")))


def _compare_group(group: pa.RecordBatch, threshold: float, seed: int, out: dict) -> None:
    """Add the link counts and the spanning links of one group's rows to ``out``."""
    n = group.num_rows
    # rows of another label, length or table can only share a group by a clash of hashes
    same = {}
    sizes = np.diff(group.column("v").offsets.to_numpy())
    for i, who in enumerate(zip(group.column("label_").to_pylist(), sizes.tolist(), group.column("t").to_pylist(),
                                group.column("bucket").to_pylist())):
        same.setdefault(who, []).append(i)
    rep = group.column("rep").to_pylist()
    copies = group.column("copies").to_numpy()
    for (_, dim, table, _), at in same.items():
        if len(at) < 2:
            continue
        at = np.array(at)
        x = np.array([group.column("v")[int(i)].values.to_numpy() for i in at])
        keys = np.array([group.column("tables")[int(i)].values.to_numpy() for i in at])
        side = group.column("side").to_numpy()[at]
        if side.any():
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
        else:
            left = right = np.arange(len(at))
        a, b = near_links(x, threshold, keys, table, left, right, seed)
        if not len(a):
            continue
        count = np.bincount(a, copies[at][b], len(at)) + np.bincount(b, copies[at][a], len(at))
        root = merged(np.arange(len(at)), [(a, b)])
        for i in np.flatnonzero(count):
            out["rep"].append(rep[at[i]])
            out["other"].append(None)
            out["n"].append(int(count[i]))
            if root[i] != i:
                out["rep"].append(rep[at[i]])
                out["other"].append(rep[at[root[i]]])
                out["n"].append(0)
