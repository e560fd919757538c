"""Graphs derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..session import stage
from ..tables import load
from .graph import Graph


def order_graph(spark: SparkSession, sf: str) -> Graph:
    """Who orders after whom: vertices are customers (attributes ``name``,
    ``region`` and ``orders``); a customer points at each other customer who
    placed the very next order (``weight`` = how often).  An edge between two
    customers of one market segment is a ``friend``, any other a ``follow``.

    Every order takes part, so the graph grows with the tables.  Both tables
    are staged once on shared storage; the algorithms read them from there.
    """
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = load(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    nxt = o.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("dst"))
    pairs = (o.join(nxt, "o_orderkey").filter(F.col("o_custkey") != F.col("dst"))
             .groupBy(F.col("o_custkey").alias("src"), "dst").agg(F.count(F.lit(1)).alias("weight")))
    seg = c.select("c_custkey", "c_mktsegment")
    edges = (pairs.join(seg.toDF("src", "_s"), "src").join(seg.toDF("dst", "_d"), "dst")
             .select("src", "dst", "weight",
                     F.when(F.col("_s") == F.col("_d"), "friend").otherwise("follow").alias("relationship")))
    placed = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    vertices = (c.join(placed, "c_custkey", "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                        F.col("n_regionkey").alias("region"), F.coalesce("orders", F.lit(0)).alias("orders")))
    return Graph(stage(vertices, "graph-vertices"), stage(edges, "graph-edges"))


ORDER_GRAPH_SQL = """
pair AS (
  SELECT a.o_custkey AS src, b.o_custkey AS dst, count(*) AS weight
  FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
  WHERE a.o_custkey <> b.o_custkey GROUP BY 1, 2),
edges AS (SELECT src, dst, weight,
                 CASE WHEN s.c_mktsegment = d.c_mktsegment THEN 'friend' ELSE 'follow' END AS relationship
          FROM pair JOIN customer s ON s.c_custkey = src JOIN customer d ON d.c_custkey = dst),
vertices AS (SELECT c_custkey AS id, c_name AS name, n_regionkey AS region, coalesce(n, 0) AS orders
             FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""
