"""Generic file sources and sinks.

Paths are caller-supplied; helpers that need a scratch location use the
shared folder named by ``spark.checkpoint.dir`` (``session.scratch_path``),
never a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def read(spark: SparkSession, fmt: str, path: str | list[str], schema: StructType | str | None = None,
         **options) -> DataFrame:
    """``spark.read.format(fmt)`` with an optional explicit schema.

    Text formats: pass ``header``, ``sep``, ``quote``... as options.  Give a
    schema for CSV/JSON in production: inference costs a full extra pass.
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def write(df: DataFrame, fmt: str, path: str | None = None, mode: str = "error",
          partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
          sort_by: list[str] | None = None, table: str | None = None, **options) -> None:
    """``df.write`` with the common layouts.

    ``mode``: error (fail if present), overwrite, append, ignore.
    ``bucket_by=(n, cols)`` + ``table`` writes a bucketed (and optionally
    sorted) catalog table stored at ``path``; later joins/aggregations on
    the bucket columns read it without a shuffle.
    """
    w = df.write.format(fmt).mode(mode)
    for k, v in options.items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols)
        if sort_by:
            w = w.sortBy(*sort_by)
    if table:
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
    else:
        w.save(path)


def roundtrip(df: DataFrame, fmt: str, label: str | None = None, schema: StructType | str | None = None,
              read_options: dict | None = None, **write_options) -> DataFrame:
    """Write ``df`` to a fresh shared path in ``fmt`` and scan it back."""
    spark = df.sparkSession
    path = scratch_path(spark, label or f"rt-{fmt}")
    write(df, fmt, path, mode="error", **write_options)
    return read(spark, fmt, path, schema=schema or (df.schema if fmt in ("csv", "json") else None),
                **(read_options or {}))


def sql_on_file(spark: SparkSession, fmt: str, path: str, select: str = "*", where: str | None = None,
                tail: str | None = None) -> DataFrame:
    """``SELECT ... FROM fmt.`path` `` without registering a table."""
    q = f"SELECT {select} FROM {fmt}.`{path}`"
    if where:
        q += f" WHERE {where}"
    if tail:
        q += f" {tail}"
    return spark.sql(q)


def to_lines(df: DataFrame, cols: list[str], sep: str = "|", out: str = "value") -> DataFrame:
    """Render rows as delimited text lines (the shape of a raw text file)."""
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]).alias(out))


def parse_lines(df: DataFrame, schema: StructType, sep: str = "|", col: str = "value") -> DataFrame:
    """Typed columns from delimited lines with a given or generated schema.

    Fields that do not parse become NULL (``try_cast``) instead of failing.
    """
    import re

    parts = F.split(F.col(col), re.escape(sep))
    return df.select(*[parts[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def generated_schema(names: list[str], dtype: str = "double") -> StructType:
    """Schema built from a column list (e.g. ``f0..fN`` of a numeric file)."""
    return StructType.fromJson({"type": "struct", "fields": [
        {"name": n, "type": dtype, "nullable": True, "metadata": {}} for n in names]})


def key_partition(df: DataFrame, key: str, n: int, out: str = "part") -> DataFrame:
    """Custom partitioner ``key mod n`` as a column (for ``partitionBy``)."""
    return df.withColumn(out, F.pmod(F.col(key), F.lit(n)).cast("int"))


def text_lines(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """``textFile``: one row per line in column ``value``.  The number of
    partitions follows ``spark.sql.files.maxPartitionBytes``."""
    r = spark.read.format("text")
    if whole_text:
        r = r.option("wholetext", "true")
    return r.load(path)


def bounded_pandas(df: DataFrame, n: int):
    """``toPandas`` of a DataFrame with at most ``n`` rows; more rows raise."""
    got = df.limit(n + 1).toPandas()
    if len(got) > n:
        raise ValueError(f"more than {n} rows; aggregate or raise the bound")
    return got
