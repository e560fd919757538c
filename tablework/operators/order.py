"""Sorting, top-k and look-ups.

``orderBy`` becomes a range-partitioned sort; ``orderBy(...).limit(k)``
becomes TakeOrderedAndProject (a per-partition top-k, then a k-row merge),
so top-k never sorts or shuffles the full input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(c: str | Column | tuple) -> Column:
    if isinstance(c, tuple):
        name, direction = c
        col = F.col(name) if isinstance(name, str) else name
        return col.desc() if direction.lower().startswith("d") else col.asc()
    return F.col(c) if isinstance(c, str) else c


def sort(df: DataFrame, keys: list, position: str | None = None) -> DataFrame:
    """Total sort; keys are names, Columns or ``(name, "asc"|"desc")``.

    With ``position`` every row also gets its 0-based place in the order (give a unique tie-break key): rows are
    numbered as the range sort writes them, so the order stays with the rows wherever they go.
    """
    ks = [_key(k) for k in keys]
    if position is None:
        return df.orderBy(*ks)
    from .splits import ordered_index

    return ordered_index(df, ks, position).orderBy(position)


def top_k(df: DataFrame, k: int, keys: list) -> DataFrame:
    """First ``k`` rows of ``keys`` order (give a unique tie-break key)."""
    return df.orderBy(*[_key(x) for x in keys]).limit(k)


def secondary_sort(df: DataFrame, keys: list, partitions: int | None = None,
                   global_order: bool = True, position: str | None = None) -> DataFrame:
    """Composite-key sort.  With ``global_order=False`` the output is only
    range-partitioned on the first key and sorted inside partitions, which
    is what a file writer needs and avoids a final single-stream merge.
    ``position`` is as in ``sort``, without the final sort."""
    ks = [_key(k) for k in keys]
    if position is not None:
        from .splits import ordered_index

        return ordered_index(df, ks, position, partitions)
    if global_order:
        return df.orderBy(*ks)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *ks).sortWithinPartitions(*ks)


def lookup(df: DataFrame, key: str, value, out: list[str] | None = None) -> DataFrame:
    """``lookup(k)``: rows whose ``key`` equals ``value`` (pushed to the scan)."""
    res = df.filter(F.col(key) == F.lit(value))
    return res.select(*out) if out else res


def as_map(df: DataFrame, key: str, value: str, out: str = "m", max_keys: int = 10_000) -> DataFrame:
    """``collectAsMap``: one map of ``key -> value`` of a table that is already
    aggregated to a bounded key set (one row per category).  More than
    ``max_keys`` rows raise, before anything is gathered in one task."""
    if len(df.select(key).take(max_keys + 1)) > max_keys:
        raise ValueError(f"more than {max_keys} keys; keep the table, or aggregate it further")
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))))
    return df.agg(F.map_from_entries(entries).alias(out))


def map_text(m: str, sep: str = ",") -> Column:
    """Render a map as ``k=v`` pairs sorted by key (engine-neutral text)."""
    ents = F.array_sort(F.map_entries(F.col(m)))
    return F.array_join(F.transform(ents, lambda e: F.concat(e["key"].cast("string"), F.lit("="),
                                                             e["value"].cast("string"))), sep)
