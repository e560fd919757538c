"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import is_scratch, scratch_path

#: Bytes of text that a Python step works on at a time.
SLICE_BYTES = 4 << 20


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read again after a loss,
    and makes later uses of the rows identical even where they depend on sampling.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_apart(df: DataFrame, label: str, batch: int | None = None) -> DataFrame:
    """``staged`` by a session of its own, in which the shuffle files of a query go when it ends.

    For a plan with large shuffles whose result is all that is read later; the settings of
    ``df``'s session are copied and stay as they are.  Python workers receive ``batch`` rows at a time,
    or as many as the session says.
    """
    spark = df.sparkSession
    apart = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            apart.conf.set(name, value)
    apart.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if batch is not None:
        apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    view = f"apart_{uuid.uuid4().hex}"
    path = scratch_path(spark, label)
    df.createGlobalTempView(view)
    try:
        apart.table(f"global_temp.{view}").write.parquet(path)
    finally:
        spark.catalog.dropGlobalTempView(view)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the staged table that ``df`` reads, when all that is made of it is staged itself.

    Only a folder that ``scratch_path`` has handed out is deleted.
    """
    jvm, conf = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if is_scratch(folder):
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def staged_rows(spark: SparkSession, rows: list, schema: str, label: str) -> DataFrame:
    """A few driver-side rows as a table."""
    return staged(spark.createDataFrame(rows, schema).coalesce(1), label)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def others(df: DataFrame, outputs: list[str]) -> list[str]:
    """Input columns that stay beside ``outputs``."""
    taken = {o.lower() for o in outputs}
    return [c for c in df.columns if c.lower() not in taken]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    first = size = 0
    for i, n in enumerate(sizes):
        if i > first and size + n > limit:
            yield batch.slice(first, i - first)
            first, size = i, 0
        size += int(n)
    yield batch.slice(first)


def map_text(df: DataFrame, text: str, outputs: T.StructType, make_step: Callable,
             keep: list[str] | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """Add columns computed from a text column, slice by slice, in Python workers.

    ``make_step()`` runs once per task and returns a function from an Arrow array of
    texts (about ``limit`` bytes of them) to one Arrow array for each field of ``outputs``.
    ``keep`` names the input columns to return (all, if none are given).
    """
    names = others(df, outputs.names)
    if keep is not None:
        names = [c for c in names if c in keep]
    if text in names and isinstance(df.schema[text].dataType, T.StringType):
        src, at, first = df.select(*[F.col(f"`{c}`") for c in names]), names.index(text), 0
    else:  # the text comes first under a name of its own, so that outputs may replace it
        own = F.col(f"`{text}`").cast("string").alias(free_name(df, "text_in"))
        src, at, first = df.select(own, *[F.col(f"`{c}`") for c in names]), 0, 1
    schema = T.StructType(src.schema.fields[first:] + list(outputs.fields))

    def run(batches):
        step = make_step()
        for batch in batches:
            for part in slices(batch, at, limit):
                made = step(pc.fill_null(part.column(at), ""))
                yield pa.RecordBatch.from_arrays(part.columns[first:] + list(made), names=schema.names)

    return src.mapInArrow(run, schema)


def as_bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def coded_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of all but ASCII white space: the texts' words one after another as places in a list of
    the distinct ones, each text's first place (and the end of the last), and that list.

    With ``lower``, A-Z are lower-cased.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = parts.flatten().dictionary_encode()
    codes, at = coded.indices.to_numpy(), parts.offsets.to_numpy()
    names = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    at = at - at[0]
    if b"" in names:  # white space at a text's ends
        real = codes != names.index(b"")
        at = np.concatenate([[0], np.cumsum(real)])[at]
        codes = codes[real]
    return codes, at, names


def strung(values: list[bytes], codes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For each text the 32-bit ``values`` of its ``codes`` one after another; ``at`` as of ``coded_words``."""
    sizes = np.array([len(v) // 4 for v in values], np.int64)
    flat = np.frombuffer(b"".join(values), "<u4")
    first = np.cumsum(sizes) - sizes
    # a code's first place in ``flat``, then one place on for each further value
    count = sizes[codes]
    ends = np.cumsum(count)
    made = flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first[codes] - (ends - count), count)]
    cuts = np.concatenate([[0], ends])[at]
    return [made[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


class Memory:
    """Values by key for a bounded number of keys; those not asked for lately are forgotten first."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def lookup(self, keys: list, make: Callable[[list], list]) -> list:
        """Values of distinct ``keys``; ``make`` computes those not remembered."""
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        new = []
        for i in [i for i, v in enumerate(found) if v is None]:
            v = old.get(keys[i])
            if v is None:
                new.append(i)
            else:
                found[i] = young[keys[i]] = v
        for i, v in zip(new, make([keys[i] for i in new]) if new else []):
            found[i] = young[keys[i]] = v
        if len(young) > self.entries // 2:
            self.old, self.young = young, {}
        return found


def literal_bounds(df: DataFrame, key: str, parts: int, per_part: int = 16) -> list:
    """At most ``parts - 1`` ascending values of ``key`` that cut ``df`` into parts of about equal size.

    They come from a random sample of about ``parts * per_part`` keys, drawn where the rows
    are; they only deal out work and are literals from then on, so a recomputed task
    deals alike.
    """
    rows = df.count()
    got = df.select(F.col(key).alias("k")).sample(min(1.0, parts * per_part / max(1, rows)), seed=7).collect()
    keys = sorted(r[0] for r in got if r[0] is not None)
    if not keys:
        return []
    return sorted({keys[len(keys) * i // parts] for i in range(1, parts)})
