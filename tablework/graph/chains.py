"""Shrinking a directed graph before its strongly connected components are searched.

Two steps take turns.  Vertices without an edge in or out are components of their own and are peeled
off.  A chain, a path of vertices with one edge in and one out, is replaced by one edge between its ends; its
vertices belong to the component of these if both are in the same one, and are alone otherwise.  Chains are found by
pointer doubling, so a line of n vertices takes about log2(n) rounds, and a tree or a line that
leads into a cycle melts away in a few turns.  A cycle of chain vertices alone is a component.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def peel(ids: DataFrame, edges: DataFrame, cut) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(peeled, ids, edges): the vertices without an edge in or out, and what is left without them."""
    inner = cut(edges.select(F.col("src").alias("id")).distinct().join(edges.select(F.col("dst").alias("id")).distinct(), "id"))
    peeled = cut(ids.join(inner, "id", "left_anti"))
    left = edges.join(inner.withColumnRenamed("id", "src"), "src", "left_semi").join(inner.withColumnRenamed("id", "dst"), "dst", "left_semi")
    return peeled, inner, cut(left.select("src", "dst"))


def contract(edges: DataFrame, cut) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """(cycles, chains, edges, rounds): (id, component) of cycles of chain vertices, (id, u, w) of the other chain vertices with
    the ends of their chain, and the edges with every chain as one edge from u to w (none where these are the same)."""
    out = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("next")).filter("n = 1")
    into = edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("src").alias("before")).filter("n = 1")
    chain = cut(out.select("id", "next").join(into.select("id", "before"), "id"))
    inside = chain.select(F.col("id").alias("next"), F.lit(True).alias("on"))
    # tail: the last vertex of the chain seen from here; low: the smallest id up to it; open: it goes on
    at = cut(chain.join(inside, "next", "left").select(
        "id", F.when(F.col("on"), F.col("next")).otherwise(F.col("id")).alias("tail"), F.col("id").alias("low"), F.coalesce("on", F.lit(False)).alias("open")))
    n = at.count()
    rounds = 0
    for _ in range(ceil(log2(n + 1)) + 1 if n else 0):
        if at.filter("open").limit(1).count() == 0:
            break
        there = at.select(F.col("id").alias("tail"), F.col("tail").alias("tail_"), F.col("low").alias("low_"), F.col("open").alias("open_"))
        at = cut(at.join(there, "tail").select(
            "id", F.col("tail_").alias("tail"), F.when(F.col("open"), F.least("low", "low_")).otherwise(F.col("low")).alias("low"),
            (F.col("open") & F.col("open_")).alias("open")))
        rounds += 1
    # what still goes on after so many doublings goes round
    cycles = cut(at.filter("open").select("id", F.col("low").alias("component")))
    member = at.filter(~F.col("open")).select("id", "tail")
    end = chain.select(F.col("id").alias("tail"), F.col("next").alias("w"))
    heads = chain.join(chain.select(F.col("id").alias("before")), "before", "left_anti").select("id", F.col("before").alias("u"))
    ends = cut(heads.join(member, "id").select("tail", "u").join(end, "tail"))
    chains = cut(member.join(ends, "tail").select("id", "u", "w"))
    gone = chain.select("id")
    kept = (edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti").join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti")
            .select("src", "dst"))
    short = ends.filter(F.col("u") != F.col("w")).select(F.col("u").alias("src"), F.col("w").alias("dst"))
    return cycles, chains, cut(kept.union(short).distinct()), rounds


def resolve(done: DataFrame, chains: DataFrame) -> DataFrame:
    """(id, component) of chain vertices, from those of the ends of their chains."""
    a = done.select(F.col("id").alias("u"), F.col("component").alias("cu"))
    b = done.select(F.col("id").alias("w"), F.col("component").alias("cw"))
    return chains.join(a, "u").join(b, "w").select("id", F.when(F.col("cu") == F.col("cw"), F.col("cu")).otherwise(F.col("id")).alias("component"))
