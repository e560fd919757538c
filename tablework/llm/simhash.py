"""SimHash near-duplicates by a generalised pigeonhole search.

A text's fingerprint has 64 bits; a bit is set if it is set in over half of the
hashes of its word shingles.  Two texts are linked if few bits differ.

The 64 bits are split into partitions, bits that vary together in the same one, so
that the partitions are as independent of each other as the data allow.  With m
partitions whose thresholds add up to (distance - m + 1), two fingerprints within the
distance must agree to within its threshold in some partition; a threshold of -1 leaves
a partition out.  Number and thresholds come from dynamic programming over the
estimated number of candidates of each partition.  Every distinct fingerprint is
stored under its own value in each partition and probes the values within the
threshold; what meets there is verified on all 64 bits.

Exact copies are one fingerprint from the start.  A value shared by very many
fingerprints is compared in blocks of bounded size, and a block returns the links of
a spanning forest, never all its pairs.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import grouped_batches, in_blocks, spanning_links
from .common import as_bytes, map_text, shuffle_partitions, staged
from .components import components

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text: words of all but ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    digest, joined = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        return digest(joined(words), seed)
    counts = np.zeros(BITS, np.int64)
    total = len(words) - shingle + 1
    for i in range(0, total, 65_536):  # bits of so many shingles at a time
        part = words[i:min(i + 65_536, total) + shingle - 1]
        hashes = np.array([digest(joined(s), seed) for s in zip(*(part[j:] for j in range(shingle)))], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def add_fingerprints(df: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp",
                     keep: list[str] | None = None) -> DataFrame:
    """Add ``out`` (long): the fingerprint's 64 bits.  A null or empty text has fingerprint zero."""
    def make():
        def step(texts):
            found = np.array([fingerprint(t, shingle) for t in as_bytes(texts)], np.uint64)
            return [pa.array(found.view(np.int64))]
        return step
    return map_text(df, text, T.StructType([T.StructField(out, T.LongType())]), make, keep)


def bit_groups(fps: DataFrame, fp: str = "fp") -> np.ndarray:
    """Absolute correlation of each pair of bits over all fingerprints (64 x 64)."""
    def run(batches):
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8)
            bits = np.unpackbits(found, bitorder="little").reshape(-1, BITS).astype(np.float32)
            both += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(both.ravel()), pa.array(np.full(BITS * BITS, n))],
                                         names=["i", "j", "both", "n"])
    # a row per pair of bits: 4096 rows whatever the input
    got = (fps.select(fp).mapInArrow(run, "i long, j long, both long, n long")
           .groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect())
    both, n = np.zeros((BITS, BITS)), 1
    for r in got:
        both[r["i"], r["j"]], n = r["both"], max(1, r["n"])
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd))


def partitions(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` sets of bits; each grows from the bit with the strongest ties by the bit most tied to it."""
    left, out = set(range(BITS)), []
    for i in range(m):
        size = (len(left) + m - i - 1) // (m - i)
        free = sorted(left)
        first = max(free, key=lambda b: (correlation[b, free].sum(), -b))
        own = [first]
        left.discard(first)
        while len(own) < size:
            free = sorted(left)
            ties = correlation[np.ix_(own, free)].sum(0)
            own.append(free[int(ties.argmax())])
            left.discard(own[-1])
        out.append(sorted(own))
    return out


def allocate(widths: list[int], meets: list[float], distance: int, unit: float = 0.05) -> tuple[float, list[int]]:
    """Cheapest thresholds with sum ``distance - m + 1``, by dynamic programming.

    ``meets[i]``: fingerprints that share a fingerprint's value in partition i, on
    average.  A value some bits away meets no more than that on average (the sum of
    products is at most the sum of squares), so a partition with threshold t costs its
    probes, and for each probe at most ``meets[i]`` candidates of ``unit`` cost each.
    """
    best = {0: (0.0, [])}
    for width, meet in zip(widths, meets):
        now: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                probes = sum(comb(width, j) for j in range(t + 1))
                if (probes > 5000):
                    break
                c = cost + probes * (1 + unit * meet)
                if used + t not in now or c < now[used + t][0]:
                    now[used + t] = (c, chosen + [t])
        best = now
    return best.get(distance - len(widths) + 1, (float("inf"), []))


def _value(fp, bits: list[int]):
    """The bits of one partition, in place."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def plan(fps: DataFrame, distance: int, choices: tuple[int, ...] = (1, 2, 3, 4)) -> list[tuple[list[int], int]]:
    """Partitions (bits, threshold) for the distinct fingerprints ``fps``."""
    correlation = bit_groups(fps)
    # one partition of all bits has few enough probes only for the smallest distances
    cuts = {m: partitions(correlation, m) for m in choices if m <= distance + 1 and (m > 1 or distance < 2)}
    # how many fingerprints share a value: a sum of squares for each partition
    values = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), _value(F.col("fp"), bits).alias("v"))
                       for m, groups in cuts.items() for i, bits in enumerate(groups)])
    same = (fps.select(F.explode(values).alias("x")).groupBy("x.m", "x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("m", "i").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
                                   F.sum("n").alias("n")).collect())
    meets = {(r["m"], r["i"]): r["squares"] / r["n"] for r in same}
    best = min((allocate([len(b) for b in groups], [meets.get((m, i), 1.0) for i in range(m)], distance), m)
               for m, groups in cuts.items())
    (_, thresholds), m = best
    return [(bits, t) for bits, t in zip(cuts[m], thresholds) if t >= 0]


def _masks(bits: list[int], threshold: int) -> list[int]:
    out = []
    for t in range(threshold + 1):
        for some in combinations(bits, t):
            mask = sum(1 << b for b in some)
            out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(fps: DataFrame, distance: int = 3, block: int = 2048) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most ``distance`` bits apart.

    ``fps``: one row (fp) for each distinct fingerprint.  The links returned join
    exactly the fingerprints that all links would join.
    """
    chosen = plan(fps, distance)
    fp = F.col("fp")

    def probes(i: int, bits: list[int], threshold: int):
        return F.transform(F.lit(_masks(bits, threshold)), lambda mask: F.xxhash64(F.lit(i), _value(fp, bits).bitwiseXOR(mask)))

    keys = [probes(i, bits, t) for i, (bits, t) in enumerate(chosen)]
    # probes and stored values meet under the same key; the first key of a partition is the stored value
    rows = fps.select("fp", F.posexplode(F.concat(*keys)).alias("n", "key"))
    met = in_blocks(rows, "key", "fp", block)

    def run(batches):
        for batch in grouped_batches(batches):
            group = batch.column("gid").to_numpy()
            found = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            a, b = spanning_links(group, found, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return (met.select("gid", "fp").repartition(shuffle_partitions(fps.sparkSession), "gid")
            .sortWithinPartitions("gid", "fp").mapInArrow(run, "a long, b long"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row per input row: ``key``, fp (long) and component_id.

    ``component_id`` is the smallest key among the rows reached over links of at most
    ``distance`` differing bits (null where all those keys are null).  Empty and null
    texts share fingerprint zero and are linked like any others; repeated rows are
    linked with each other; an empty table gives an empty result.
    """
    docs = staged(add_fingerprints(df.select(F.col(f"`{key}`").alias("id_"), F.col(f"`{text}`").alias("text")), "text",
                                   shingle, keep=["id_"]), "simhash-docs")
    return docs.join(classes(docs, distance), "fp", "left").select(F.col("id_").alias(key), "fp", "component_id")


def classes(docs: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of the stored rows ``docs`` (id_, fp)."""
    first = staged(docs.groupBy("fp").agg(F.min("id_").alias("first")), "simhash-fps")
    joined = components(staged(links(first.select("fp"), distance), "simhash-links"), "simhash-components")
    rooted = staged(first.join(joined.select(F.col("id").alias("fp"), "root"), "fp", "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    lowest = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-lowest")
    return staged(rooted.join(lowest, "root").select("fp", "root", "component_id"), "simhash-classes")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each group of linked rows, with its columns as they are.

    The row with the smallest key stays; of rows that repeat that key, one with the
    smallest fingerprint; of rows alike in key and text, the one whose other columns sort first; null keys come last.
    """
    own = ["key_", "hash_", "order_", "kept_key_", "kept_hash_"]
    while any(c.lower() in own for c in df.columns):
        own = ["_" + c for c in own]
    key_, hash_, order, kept_key, kept_hash = own
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = staged(add_fingerprints(df.select(F.col(f"`{key}`").alias("id_"), body.alias("text"), F.xxhash64(body).alias("hash")),
                                   "text", shingle, keep=["id_", "hash"]), "simhash-docs")
    best = (docs.join(classes(docs, distance).select("fp", "root"), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("id_").isNull().alias("none"), "id_", "fp", "hash")).alias("best")))
    times = docs.groupBy(_named(F.col("id_")).alias("k"), F.col("hash").alias("h")).agg(F.count(F.lit(1)).alias(order))
    kept = staged(best.select(_named(F.col("best.id_")).alias(kept_key), F.col("best.hash").alias(kept_hash))
                  .join(times, (F.col(kept_key) == F.col("k")) & (F.col(kept_hash) == F.col("h"))).drop("k", "h"), "simhash-kept")
    # the hash tells rows that repeat a key apart; the texts themselves pass through one join, without Python
    marked = (df.withColumn(key_, _named(F.col(f"`{key}`"))).withColumn(hash_, F.xxhash64(body))
              .join(kept, (F.col(key_) == F.col(kept_key)) & (F.col(hash_) == F.col(kept_hash))))
    columns = [F.col(f"`{c}`") for c in df.columns]
    if kept.filter(F.col(order) > 1).isEmpty():
        return marked.select(*columns)
    # copies of a row, key and text alike, become one where they lie, before any shuffle by key
    ordered = [F.col(f"`{f.name}`") for f in df.schema.fields if _orderable(f.dataType)]
    copies = marked.filter(F.col(order) > 1).groupBy(key_, hash_).agg(
        F.min_by(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]), F.struct(body, *ordered)).alias(order))
    one = copies.select(*[F.col(f"{order}.c{i}").alias(c) for i, c in enumerate(df.columns)])
    return marked.filter(F.col(order) == 1).select(*columns).unionByName(one)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _named(key):
    """The key as text, so that a null key can be joined as well."""
    return F.when(key.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), key.cast("string")))
