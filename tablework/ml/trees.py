"""Fitted trees as tables (M11, M22): nodes, rules, and scoring by joins.

A tree model's saved data is a table already; ``nodes`` gives it one shape for single trees and
forests.  ``rules`` unrolls each leaf's path into conditions, ``descend`` takes rows down all trees by one
join a level, so that leaves, paths and predictions can be queried, joined and checked like any data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .features import to_array


def nodes(spark: SparkSession, model) -> DataFrame:
    """(tree, id, left, right, feature, threshold, categories, prediction, stats, n, gain) of a tree or forest model.

    A leaf has null children, feature and split.  ``threshold`` is set for a continuous feature (left: at or
    below), ``categories`` for a categorical one (left: among them).  ``n`` counts the training rows at a
    node (of a forest: of the tree's own sample), ``stats`` is the impurity's summary of them.
    """
    p = scratch_path(spark, "tree-model")
    model.write().save(p)
    data = spark.read.parquet(f"{p}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    inner, split = F.col("leftChild") >= 0, F.col("split")
    continuous = split["numCategories"] == -1
    return data.select(
        "tree", "id", F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & continuous, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, split["leftCategoriesOrThreshold"]).alias("categories"),
        "prediction", F.col("impurityStats").alias("stats"), F.col("rawCount").alias("n"), F.when(inner, F.col("gain")).alias("gain"))


def _goes_left(value):
    return F.when(F.col("threshold").isNotNull(), value <= F.col("threshold")).otherwise(F.array_contains("categories", value))


def depth(table: DataFrame) -> int:
    """Edges on the longest path from a root to a leaf."""
    found, level = 0, table.filter("id = 0").select("tree", "left", "right")
    while True:
        below = level.select("tree", F.explode(F.array("left", "right")).alias("id")).filter("id is not null")
        level = stage(table.join(below, ["tree", "id"]).select("tree", "left", "right"), "tree-level")
        if level.isEmpty():
            return found
        found += 1


def rules(table: DataFrame, names: list[str]) -> DataFrame:
    """(tree, id, rule, depth, prediction, n): each leaf and the conditions on its path, of features called ``names``."""
    label = F.get(F.lit(names), F.col("feature"))
    shown = F.when(F.col("threshold").isNotNull(), F.concat(label, F.lit(" {} "), F.col("threshold").cast("string"))).otherwise(
        F.concat(label, F.lit(" {} ("), F.array_join(F.col("categories").cast("array<string>"), ", "), F.lit(")")))
    yes = F.when(F.col("threshold").isNotNull(), "<=").otherwise("in")
    no = F.when(F.col("threshold").isNotNull(), ">").otherwise("not in")

    def side(child: str, sign):
        return F.struct(F.col(child).alias("id"), F.concat_ws(" and ", F.nullif("rule", F.lit("")), F.replace(shown, F.lit("{}"), sign)).alias("rule"))

    level = table.filter("id = 0").withColumn("rule", F.lit("")).withColumn("depth", F.lit(0))
    leaves = None
    while True:
        level = stage(level, "tree-rules")
        done = level.filter("left is null").select("tree", "id", "rule", "depth", "prediction", "n")
        leaves = done if leaves is None else leaves.unionByName(done)
        inner = level.filter("left is not null")
        if inner.isEmpty():
            return leaves
        below = inner.select("tree", F.explode(F.array(side("left", yes), side("right", no))).alias("c"), (F.col("depth") + 1).alias("depth"))
        level = table.join(below.select("tree", "c.id", "c.rule", "depth"), ["tree", "id"])


def descend(rows: DataFrame, table: DataFrame, features: str = "features") -> DataFrame:
    """Every row once for each tree, with ``tree``, ``leaf``, ``leaf_prediction``, ``leaf_stats`` and ``leaf_n``.

    One join of the rows with the node table a level; the table has the size of the model.  ``features`` is a vector.
    """
    table = stage(table, "tree-nodes")
    roots = [r["tree"] for r in table.filter("id = 0").select("tree").orderBy("tree").collect()]
    at = rows.withColumn("_x", to_array(features)).withColumn("tree", F.explode(F.lit(roots))).withColumn("leaf", F.lit(0))
    here = table.select(F.col("tree").alias("_t"), F.col("id").alias("_id"), "left", "right", "feature", "threshold", "categories")
    for _ in range(depth(table)):
        to = F.when(F.col("left").isNull(), F.col("leaf")).when(_goes_left(F.get("_x", F.col("feature"))), F.col("left")).otherwise(F.col("right"))
        at = (at.join(here, (F.col("tree") == F.col("_t")) & (F.col("leaf") == F.col("_id")))
              .withColumn("leaf", to).drop("_t", "_id", "left", "right", "feature", "threshold", "categories"))
    last = table.select(F.col("tree").alias("_t"), F.col("id").alias("_id"), F.col("prediction").alias("leaf_prediction"),
                        F.col("stats").alias("leaf_stats"), F.col("n").alias("leaf_n"))
    return at.join(last, (F.col("tree") == F.col("_t")) & (F.col("leaf") == F.col("_id"))).drop("_t", "_id", "_x")


def predict(rows: DataFrame, table: DataFrame, key: list[str], classes: int | None = None, features: str = "features") -> DataFrame:
    """``key`` and ``prediction``: the mean over the trees, or with ``classes`` the class with the greatest sum of
    the leaves' shares (ties: the lowest)."""
    down = descend(rows, table, features).groupBy(*key)
    if classes is None:
        return down.agg(F.avg("leaf_prediction").alias("prediction"))
    whole = F.aggregate("leaf_stats", F.lit(0.0), lambda s, x: s + x)
    votes = down.agg(F.array(*[F.sum(F.get("leaf_stats", F.lit(i)) / whole) for i in range(classes)]).alias("_v"))
    return votes.select(*key, (F.array_position("_v", F.array_max("_v")) - 1).cast("double").alias("prediction"))
