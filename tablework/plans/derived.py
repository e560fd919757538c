"""Derived inputs shared by several queries, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import r
from ..tables import load


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """Explicit ratings from purchases: user = customer, item = part,
    rating = mean quantity, ts = first order date of the pair."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return (j.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
            .agg(r(F.avg("l_quantity"), 4).alias("rating"), F.min("o_orderdate").alias("ts")))


def doc_features(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with numeric text features (``label`` = quality)."""
    d = load(spark, sf, "documents").join(load(spark, sf, "labels"), "doc_id")
    return d.select(
        "doc_id", F.col("quality").cast("double").alias("label"), "lang", "source",
        (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double").alias("n_spaces"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("double").alias("n_lines"),
        F.length(F.regexp_replace("text", "[^0-9]", "")).cast("double").alias("n_digits"),
        F.col("n_chars").cast("double").alias("n_chars"), *doc_shares())


#: Shares of a text's characters that tell good texts from bad ones.
SHARES = {"upper_share": "[^A-Z]", "letter_share": "[^A-Za-z]", "sign_share": r"[\w\s.,!?]"}


def doc_shares(text: str = "text") -> list:
    """A column for each of ``SHARES``: what is left without the pattern, over the length."""
    n = F.greatest(F.length(text), F.lit(1))
    return [(F.length(F.regexp_replace(text, p, "")) / n).alias(c) for c, p in SHARES.items()]


def rating_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """The (user, item) pairs of ``ratings`` alone."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).distinct())


RATINGS_SQL = """
ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item, round(avg(l_quantity), 4) AS rating,
         min(o_orderdate) AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, l_partkey)"""
