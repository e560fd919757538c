"""Projection, filter and scalar-function queries (P01-P20, F01-F10, S06, S20, §2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r, ts_str
from ..operators import rows
from ..session import scratch_path
from ..sources import cells
from ..tables import load
from .registry import query


@query("proj_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def proj_columns(spark, sf):
    c = load(spark, sf, "customer")
    return c.select("c_custkey", c.c_name, c["c_mktsegment"])


@query("proj_computed", """
SELECT o_orderkey, 2024 - year(o_orderdate) AS age_years,
       round(o_totalprice * 1.1, 4) AS price_with_tax
FROM orders""")
def proj_computed(spark, sf):
    o = load(spark, sf, "orders")
    return o.select("o_orderkey", (F.lit(2024) - F.year("o_orderdate")).alias("age_years"),
                    r(o.o_totalprice * 1.1).alias("price_with_tax"))


@query("proj_reshape", """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment AS segment,
       round(c_acctbal / 1000, 6) AS bal_k
FROM customer""")
def proj_reshape(spark, sf):
    c = load(spark, sf, "customer")
    return (c.withColumn("bal_k", r(F.col("c_acctbal") / 1000, 6)).drop("c_name")
            .withColumnRenamed("c_mktsegment", "segment"))


@query("proj_cast_all", """
SELECT TRY_CAST(p_partkey AS DOUBLE) AS p_partkey, TRY_CAST(p_name AS DOUBLE) AS p_name,
       TRY_CAST(p_brand AS DOUBLE) AS p_brand, TRY_CAST(p_type AS DOUBLE) AS p_type,
       TRY_CAST(p_size AS DOUBLE) AS p_size, TRY_CAST(p_retailprice AS DOUBLE) AS p_retailprice
FROM part""")
def proj_cast_all(spark, sf):
    return rows.cast_all(load(spark, sf, "part"), "double")


@query("proj_expr", """
SELECT CAST(o_orderkey AS VARCHAR) AS key,
       CONCAT(o_orderstatus, ':', CAST(o_custkey AS VARCHAR)) AS value
FROM orders""")
def proj_expr(spark, sf):
    return load(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS key",
        "CONCAT(o_orderstatus, ':', CAST(o_custkey AS STRING)) AS value")


@query("struct_expand", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def struct_expand(spark, sf):
    o = load(spark, sf, "orders")
    return o.select(F.struct("o_orderkey", "o_custkey", "o_orderstatus").alias("e")).select("e.*")


@query("self_alias", """
SELECT a.o_orderkey AS order_key, b.o_orderkey AS next_key,
       round(b.o_totalprice - a.o_totalprice, 4) AS price_delta
FROM orders a JOIN orders b ON a.o_orderkey + 1 = b.o_orderkey""")
def self_alias(spark, sf):
    o = load(spark, sf, "orders")
    a, b = o.alias("a"), o.alias("b")
    return a.join(b, F.col("a.o_orderkey") + 1 == F.col("b.o_orderkey")).select(
        F.col("a.o_orderkey").alias("order_key"), F.col("b.o_orderkey").alias("next_key"),
        r(F.col("b.o_totalprice") - F.col("a.o_totalprice")).alias("price_delta"))


@query("map_expr", """
SELECT o_orderkey * 2 AS dbl, 'order-' || CAST(o_orderkey AS VARCHAR) AS tag,
       o_totalprice > 100000 AS big
FROM orders""")
def map_expr(spark, sf):
    o = load(spark, sf, "orders")
    return o.select((o.o_orderkey * 2).alias("dbl"),
                    F.concat(F.lit("order-"), o.o_orderkey.cast("string")).alias("tag"),
                    (o.o_totalprice > 100000).alias("big"))


@query("map_values", "SELECT l_orderkey AS k, round(pow(l_quantity, 2), 4) AS v FROM lineitem")
def map_values(spark, sf):
    p = rows.pair(load(spark, sf, "lineitem"), "l_orderkey", "l_quantity")
    return p.withColumn("v", r(F.pow("v", 2)))


@query("pair_keys", "SELECT l_orderkey AS k FROM lineitem")
def pair_keys(spark, sf):
    return rows.pair(load(spark, sf, "lineitem"), "l_orderkey", "l_quantity").select("k")


@query("pair_values", "SELECT l_quantity AS v FROM lineitem")
def pair_values(spark, sf):
    return rows.pair(load(spark, sf, "lineitem"), "l_orderkey", "l_quantity").select("v")


@query("when_fold", """
SELECT l_orderkey, l_linenumber,
       (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + (CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)
     + (CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) + (CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END)
       AS n_true,
       CASE WHEN l_quantity > 40 THEN 'bulk' WHEN l_quantity > 10 THEN 'normal' ELSE 'small' END
       AS size_class
FROM lineitem""")
def when_fold(spark, sf):
    li = load(spark, sf, "lineitem")
    conds = [li.l_returnflag == "R", li.l_linestatus == "O", li.l_discount > 0.05, li.l_quantity > 25]
    size = (F.when(li.l_quantity > 40, "bulk").when(li.l_quantity > 10, "normal")
            .otherwise("small").alias("size_class"))
    return li.select("l_orderkey", "l_linenumber", rows.fold_conditions(conds, "n_true"), size)


# Fixed code tables for the decode example (line-item status codes).
RETURN_FLAGS = {"A": "accepted", "N": "none", "R": "returned"}
LINE_STATUS = {"F": "filled", "O": "open"}


@query("decode_map", """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' WHEN 'R' THEN 'returned' END
         AS return_label,
       CASE l_linestatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS status_label
FROM lineitem""")
def decode_map(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    li = rows.decode(li, "l_returnflag", RETURN_FLAGS, "return_label")
    li = rows.decode(li, "l_linestatus", LINE_STATUS, "status_label")
    return li.drop("l_returnflag", "l_linestatus")


@query("denormalise", """
SELECT l_orderkey, l_linenumber, round(l_discount * 100, 4) AS l_discount,
       round(l_tax * 100, 4) AS l_tax
FROM lineitem""")
def denormalise(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return rows.denormalise(li, {"l_discount": 100, "l_tax": 100})


@query("clean_missing", """
SELECT c_custkey,
       CASE WHEN COALESCE(TRY_CAST(c_acctbal AS DOUBLE), 0.0) < 0 THEN 0.0
            ELSE COALESCE(TRY_CAST(c_acctbal AS DOUBLE), 0.0) END AS c_acctbal,
       CASE WHEN COALESCE(TRY_CAST(c_mktsegment AS DOUBLE), 0.0) < 0 THEN 0.0
            ELSE COALESCE(TRY_CAST(c_mktsegment AS DOUBLE), 0.0) END AS c_mktsegment
FROM customer""")
def clean_missing(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return rows.clean_missing(c, ["c_acctbal", "c_mktsegment"], 0.0, clamp_negative=True)


@query("label_shift", """
SELECT vec_id, label - 1 AS label, CAST(k AS INTEGER) AS slot, round(CAST(embedding[k + 1] AS DOUBLE), 4) AS feature
FROM embeddings, range(64) t(k)""")
def label_shift(spark, sf):
    e = load(spark, sf, "embeddings")
    return e.select("vec_id", (F.col("label") - 1).alias("label"), F.posexplode("embedding").alias("slot", "f")) \
        .select("vec_id", "label", "slot", r("f").alias("feature"))


@query("zip_on_key", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def zip_on_key(spark, sf):
    o = load(spark, sf, "orders")
    labels = o.select("o_orderkey", "o_orderstatus")
    feats = o.select("o_orderkey", "o_totalprice")
    return rows.zip_on(labels, feats, ["o_orderkey"])


@query("category_index", """
SELECT p_partkey, p_type, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_idx FROM part""")
def category_index(spark, sf):
    return rows.category_index(load(spark, sf, "part").select("p_partkey", "p_type"), "p_type")


@query("row_format", """
SELECT 'Key: ' || c_name || ', Value: ' || CAST(c_nationkey AS VARCHAR) AS line FROM customer""")
def row_format(spark, sf):
    return load(spark, sf, "customer").select(
        rows.format_rows("Key: %s, Value: %s", "c_name", "c_nationkey").alias("line"))


# --- filters -----------------------------------------------------------------

@query("filter_contains", "SELECT doc_id, lang FROM documents WHERE contains(text, 'the')")
def filter_contains(spark, sf):
    d = load(spark, sf, "documents")
    return d.filter(d.text.contains("the")).select("doc_id", "lang")


@query("filter_compare", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_quantity < 5 OR (l_discount >= 0.09 AND l_tax = 0)""")
def filter_compare(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.filter((li.l_quantity < 5) | ((li.l_discount >= 0.09) & (li.l_tax == 0))) \
             .select("l_orderkey", "l_linenumber")


@query("filter_pair", """
SELECT o_orderstatus AS k, o_totalprice AS v FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 300000""")
def filter_pair(spark, sf):
    p = rows.pair(load(spark, sf, "orders"), "o_orderstatus", "o_totalprice")
    return p.filter(F.col("k") == "F").filter(F.col("v") > 300000)


@query("filter_chained", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity > 45""")
def filter_chained(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.filter("l_returnflag = 'R'").filter("l_quantity > 45") \
             .select("l_orderkey", "l_linenumber", "l_quantity")


@query("filter_bool", """
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE l_returnflag = 'N' AND l_linestatus = 'O' AND l_discount > 0.08""")
def filter_bool(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.filter((li.l_returnflag == "N") & (li.l_linestatus == "O") & (li.l_discount > 0.08)) \
             .select("l_orderkey", "l_linenumber")


@query("filter_between", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice BETWEEN 100000 AND 150000
  AND o_orderdate >= TIMESTAMP '1995-01-01 00:00:00' AND o_orderdate <= TIMESTAMP '1995-12-31 00:00:00'""")
def filter_between(spark, sf):
    return spark.sql("""
        SELECT o_orderkey, o_totalprice FROM {o}
        WHERE o_totalprice BETWEEN 100000 AND 150000
          AND o_orderdate >= TIMESTAMP_NTZ '1995-01-01 00:00:00'
          AND o_orderdate <= TIMESTAMP_NTZ '1995-12-31 00:00:00'""", o=load(spark, sf, "orders"))


@query("filter_hidden_col", "SELECT o_orderkey FROM orders WHERE o_totalprice > 400000")
def filter_hidden_col(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey").filter("o_totalprice > 400000")


# --- scalar function bundles -----------------------------------------------------

@query("scalar_string", """
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(p_name) AS len,
       replace(p_name, ' ', '_') AS repl,
       concat('P-', p_type, '-', CAST(p_size AS VARCHAR)) AS tag,
       trim(concat('  ', p_brand, '  ')) AS trimmed, substring(p_name, 1, 3) AS pre,
       decode(encode(p_name)) AS roundtrip
FROM part""")
def scalar_string(spark, sf):
    p = load(spark, sf, "part")
    return p.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"),
                    F.length("p_name").alias("len"),
                    F.replace("p_name", F.lit(" "), F.lit("_")).alias("repl"),
                    F.concat(F.lit("P-"), "p_type", F.lit("-"), F.col("p_size").cast("string")).alias("tag"),
                    F.trim(F.concat(F.lit("  "), "p_brand", F.lit("  "))).alias("trimmed"),
                    F.substring("p_name", 1, 3).alias("pre"),
                    F.decode(F.encode("p_name", "UTF-8"), "UTF-8").alias("roundtrip"))


@query("scalar_math", """
SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity), 4) AS sq,
       round(abs(l_discount - 0.05), 4) AS ad, round(pow(l_tax, 2), 6) AS p2,
       ((l_orderkey % 7) + 7) % 7 AS m7, -l_quantity AS neg
FROM lineitem""")
def scalar_math(spark, sf):
    li = load(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", r(F.sqrt("l_quantity")).alias("sq"),
                     r(F.abs(li.l_discount - 0.05)).alias("ad"), r(F.pow("l_tax", 2), 6).alias("p2"),
                     F.pmod("l_orderkey", F.lit(7)).alias("m7"), (-li.l_quantity).alias("neg"))


@query("scalar_time", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, year(ts) AS yr, month(ts) AS mon,
       hour(ts) AS hr, dayofweek(ts) + 1 AS dow,
       strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start,
       CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s,
       strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000),
                '%Y-%m-%d %H:%M:%S') AS from_epoch
FROM events""")
def scalar_time(spark, sf):
    e = load(spark, sf, "events")
    epoch = F.unix_seconds(F.to_utc_timestamp(e.ts.cast("timestamp"), F.current_timezone()))
    return e.select("event_id", ts_str("ts").alias("ts_text"), F.year("ts").alias("yr"),
                    F.month("ts").alias("mon"), F.hour("ts").alias("hr"),
                    F.dayofweek("ts").alias("dow"),
                    ts_str(F.date_trunc("hour", "ts")).alias("hour_start"),
                    epoch.alias("epoch_s"),
                    F.date_format(F.from_utc_timestamp(F.timestamp_seconds(epoch), F.current_timezone())
                                  .cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("from_epoch"))


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, sf):
    e = load(spark, sf, "events")
    return e.select("event_id", rows.json_field("props", "k int")["k"].alias("k"))


# --- wide-column cells (re-aimed HBase put/scan shape) -------------------------

CELL_COLUMNS = ["c_name", "c_nationkey", "c_mktsegment"]

_CELLS_SQL = " UNION ALL ".join(
    f"SELECT CAST(c_custkey AS VARCHAR) AS row, 'cf' AS family, '{c}' AS column, "
    f"CAST({c} AS VARCHAR) AS value FROM customer" for c in CELL_COLUMNS)


@query("wide_to_cells", _CELLS_SQL)
def wide_to_cells(spark, sf):
    return rows.wide_to_cells(load(spark, sf, "customer"), "c_custkey", CELL_COLUMNS)


@query("cells_to_wide", """
SELECT CAST(c_custkey AS VARCHAR) AS row, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       c_mktsegment FROM customer""")
def cells_to_wide(spark, sf):
    wide = rows.wide_to_cells(load(spark, sf, "customer"), "c_custkey", CELL_COLUMNS)
    return rows.cells_to_wide(wide, "row", "column", "value", CELL_COLUMNS)


def _stored(spark, sf):
    """A store with the cells of all customers."""
    p = scratch_path(spark, "cell-store")
    family = F.when(F.col("column") == "c_nationkey", "place").otherwise("info")
    cells.put(rows.wide_to_cells(load(spark, sf, "customer"), "c_custkey", CELL_COLUMNS).withColumn("family", family), p)
    return p


@query("cell_store_wide", """
SELECT CAST(c_custkey AS VARCHAR) AS row, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def cell_store_wide(spark, sf):
    return rows.cells_to_wide(cells.scan(spark, _stored(spark, sf)), "row", "column", "value", CELL_COLUMNS)


@query("cell_store_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS row, 'info' AS family, 'c_name' AS "column", c_name AS value FROM customer
WHERE CAST(c_custkey AS VARCHAR) >= '12' AND CAST(c_custkey AS VARCHAR) < '3'
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'info', 'c_mktsegment', c_mktsegment FROM customer
WHERE CAST(c_custkey AS VARCHAR) >= '12' AND CAST(c_custkey AS VARCHAR) < '3'""")
def cell_store_scan(spark, sf):
    return cells.scan(spark, _stored(spark, sf), "12", "3", ["info"]).drop("version")


@query("cell_store_latest", """
SELECT CAST(c_custkey AS VARCHAR) AS row, CASE WHEN n IS NULL THEN c_mktsegment ELSE 'orders ' || n END AS segment FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def cell_store_latest(spark, sf):
    """Customers with orders get a newer version of one cell."""
    p = _stored(spark, sf)
    placed = load(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cells.put(placed.select(F.col("o_custkey").alias("row"), F.lit("info").alias("family"), F.lit("c_mktsegment").alias("column"),
                            F.concat(F.lit("orders "), F.col("n")).alias("value")), p)
    return cells.latest(cells.scan(spark, p)).filter("column = 'c_mktsegment'").select("row", F.col("value").alias("segment"))
