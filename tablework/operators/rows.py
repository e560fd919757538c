"""Row-level operators: projections, casts, cleaning, decoding.

All operators are narrow (no shuffle) except ``category_index`` and
``cells_to_wide``, which aggregate.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import col, r


def cast_all(df: DataFrame, to: str = "double", cols: list[str] | None = None,
             safe: bool = True) -> DataFrame:
    """Cast every (or the listed) column; ``safe`` turns bad values into NULL
    (``try_cast``) instead of failing the job under ANSI mode."""
    cols = cols or df.columns
    conv = (lambda c: F.col(c).try_cast(to)) if safe else (lambda c: F.col(c).cast(to))
    return df.select(*[(conv(c) if c in cols else F.col(c)).alias(c) for c in df.columns])


def clean_missing(df: DataFrame, cols: list[str], fill: float = 0.0,
                  clamp_negative: bool = False, to: str = "double") -> DataFrame:
    """Parse ``cols`` as numbers; unparseable markers (e.g. ``?``) become
    ``fill``; with ``clamp_negative`` negative values become ``fill`` too."""
    def fix(c: str) -> Column:
        v = F.coalesce(F.col(c).try_cast(to), F.lit(fill).cast(to))
        if clamp_negative:
            v = F.when(v < 0, F.lit(fill).cast(to)).otherwise(v)
        return v.alias(c)
    return df.select(*[fix(c) if c in cols else F.col(c) for c in df.columns])


def decode(df: DataFrame, c: str, mapping: dict, out: str | None = None,
           default: str | None = None) -> DataFrame:
    """Replace codes by labels using a literal map (no join, no shuffle)."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    v = m[F.col(c)]
    if default is not None:
        v = F.coalesce(v, F.lit(default))
    return df.withColumn(out or c, v)


def denormalise(df: DataFrame, scales: dict[str, float], digits: int = 4) -> DataFrame:
    """Multiply normalised columns back to their natural units."""
    return df.withColumns({c: r(F.col(c) * F.lit(float(s)), digits) for c, s in scales.items()})


def fold_conditions(conds: list[Column], out: str = "n_true") -> Column:
    """Sum of 0/1 flags over several predicates (``reduce`` over columns)."""
    return reduce(lambda acc, c: acc + F.when(c, 1).otherwise(0), conds, F.lit(0)).alias(out)


def format_rows(fmt: str, *cols: str) -> Column:
    return F.format_string(fmt, *[F.col(c) for c in cols])


def json_field(c: str, schema: str) -> Column:
    """Parse a JSON text column with a DDL schema (``'k int'``)."""
    return F.from_json(F.col(c), schema)


def zip_on(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Align two derived datasets on an explicit key instead of by position."""
    return a.join(b, on=key, how="inner")


def category_index(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Dense 0-based index of the distinct values of ``c`` in sorted order,
    joined back onto ``df``.  The distinct set is numbered by a range-
    partitioned sort (``ordered_index``), so no single task sees all values."""
    from .splits import ordered_index

    out = out or f"{c}_idx"
    values = df.select(c).distinct().filter(F.col(c).isNotNull())
    idx = ordered_index(values, [c], out)
    return df.join(idx, on=c, how="left")


def cells_to_wide(cells: DataFrame, row: str, column: str, value: str,
                  columns: list[str]) -> DataFrame:
    """Wide-column cells ``(row, column, value)`` → one record per row.

    ``columns`` names the pivot values explicitly, which saves Spark the extra
    job that would otherwise collect the distinct column names.
    """
    return cells.groupBy(row).pivot(column, columns).agg(F.max(F.col(value)))


def wide_to_cells(df: DataFrame, row: str, columns: list[str], family: str = "cf",
                  column: str = "column", value: str = "value") -> DataFrame:
    """One record per row → ``(row, family, column, value)`` string cells."""
    cast = df.select(F.col(row), *[F.col(c).cast("string").alias(c) for c in columns])
    cells = cast.unpivot([row], columns, column, value)
    return cells.select(F.col(row).cast("string").alias("row"), F.lit(family).alias("family"),
                        column, value)


def pair(df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    """Key/value view of a table: columns ``k``, ``v``."""
    return df.select(col(key).alias("k"), col(value).alias("v"))
