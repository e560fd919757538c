"""UDF queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions.common import r
from ..operators import udfs
from ..tables import load
from .registry import query


@query("udf_scalar", "SELECT conv_id, turn, len(string_split(text, ' ')) AS n_tokens FROM conversations")
def udf_scalar(spark, sf):
    c = load(spark, sf, "conversations")
    return c.select("conv_id", "turn", udfs.token_count()("text").alias("n_tokens"))


@query("pandas_udf_scalar", "SELECT o_orderkey, o_custkey * o_custkey AS sq FROM orders")
def pandas_udf_scalar(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", udfs.multiply()("o_custkey", "o_custkey").alias("sq"))


@query("pandas_udf_struct", """
SELECT o_orderkey, o_orderpriority AS col1, o_custkey + length(o_orderstatus) AS col2 FROM orders""")
def pandas_udf_struct(spark, sf):
    o = load(spark, sf, "orders")
    s3 = F.struct(F.col("o_orderpriority").alias("col1"), F.col("o_orderkey").alias("col2"))
    res = o.select("o_orderkey", udfs.add_length()("o_custkey", "o_orderstatus", s3).alias("r"))
    return res.select("o_orderkey", "r.col1", "r.col2")


@query("grouped_map_center", """
SELECT l_suppkey, l_orderkey, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey), 4) AS v
FROM lineitem""")
def grouped_map_center(spark, sf):
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity")
    res = udfs.center_by_group(li, "l_suppkey", "l_quantity", "v")
    return res.select("l_suppkey", "l_orderkey", r("v").alias("v"))


@query("grouped_map_fit", """
SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem GROUP BY l_suppkey""")
def grouped_map_fit(spark, sf):
    """A line through each supplier's prices by quantity, by a grouped map over batches of rows."""
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    fit = udfs.fit_lines(li, "l_suppkey", "l_quantity", "l_extendedprice")
    return fit.select("l_suppkey", "n", r("slope").alias("slope"), r("intercept").alias("intercept"))


def _report(batches):
    """One row per partition: what a writer with one connection per partition would have sent."""
    n, total = 0, 0.0
    for pdf in batches:
        n += len(pdf)
        total += float((pdf["o_totalprice"] * 100).round().sum())
    yield pd.DataFrame({"n": [n], "cents": [total]})


@query("partition_action", """
SELECT count(*) AS n, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents FROM orders""")
def partition_action(spark, sf):
    o = load(spark, sf, "orders").select("o_totalprice")
    rep = udfs.per_partition(o, _report, "n long, cents double")
    return rep.agg(F.sum("n").alias("n"), F.sum("cents").cast("long").alias("cents"))
