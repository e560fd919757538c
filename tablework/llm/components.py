"""Connected components of a link table, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Rows (id, root) for every id in ``links`` (a, b); root is the smallest id it reaches.

    Alternates the large-star and small-star rewrites of Kiveris et al. (2014) until
    every component is a star.  Each rewrite needs one minimum per vertex, pre-aggregated
    before its shuffle.  The minima are written out and joined as a plain table, so a
    centre with very many links is a skewed join that adaptive execution splits.
    Self-links and repeated links change nothing; an empty table gives an empty result.
    """
    pairs = (links.filter(F.col("a") != F.col("b"))
             .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    edges = staged(pairs, label)
    while True:
        large, _ = _rewrite(edges, label, large=True)
        edges, changed = _rewrite(large, label, large=False)
        if not changed and _stars(edges):
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root")).union(
                edges.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct())


def _rewrite(edges: DataFrame, label: str, large: bool) -> tuple[DataFrame, bool]:
    if large:  # every larger neighbour of u moves to the smallest of u and its neighbours
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        low = staged(low, label)
        moved = (edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
                 .join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")))
        out = staged(moved.distinct(), label)
        return out, True
    # u and its smaller neighbours move to the smallest of them
    low = staged(edges.groupBy("hi").agg(F.min("lo").alias("m"), F.count(F.lit(1)).alias("n")), label)
    if low.filter(F.col("n") > 1).limit(1).count() == 0:
        return edges, False
    moved = edges.join(low, "hi").filter(F.col("lo") != F.col("m")).select(
        F.col("lo").alias("hi"), F.col("m").alias("lo"))
    out = staged(moved.union(low.select("hi", F.col("m").alias("lo"))).distinct(), label)
    return out, True


def _stars(edges: DataFrame) -> bool:
    """No vertex is both a leaf and a centre."""
    centres = edges.select(F.col("lo").alias("hi")).distinct()
    return edges.join(centres, "hi", "left_semi").limit(1).count() == 0
