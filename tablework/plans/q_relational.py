"""Join, aggregate, set, sort and split queries (J, A, T, O, H01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r
from ..operators import aggs, joins, order, rows, splits
from ..session import stage
from ..tables import load
from .derived import RATINGS_SQL, rating_pairs, ratings
from .registry import query

# --- joins ---------------------------------------------------------------------


@query("join_inner", """
SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    return joins.join(o, c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


def _left_right(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return c, o


@query("join_left", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def join_left(spark, sf):
    c, o = _left_right(spark, sf)
    return joins.join(c, o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@query("join_right", """
SELECT o_orderkey, c_custkey, s_name FROM (
  SELECT o_orderkey, o_custkey, c_custkey FROM customer RIGHT JOIN orders ON c_custkey = o_custkey) t
  LEFT JOIN supplier ON s_suppkey = o_custkey""")
def join_right(spark, sf):
    c, o = _left_right(spark, sf)
    s = load(spark, sf, "supplier").select("s_suppkey", "s_name")
    right = joins.join(c, o, c.c_custkey == o.o_custkey, "right")
    # a right join with the small table on its left: most orders find no supplier of that number
    return joins.join(s, right, s.s_suppkey == right.o_custkey, "right").select("o_orderkey", "c_custkey", "s_name")


@query("join_full", """
SELECT c_custkey, s_suppkey, o_orderkey FROM (
  SELECT c_custkey, s_suppkey FROM customer FULL JOIN supplier ON c_nationkey = s_nationkey AND c_custkey = s_suppkey) t
  FULL JOIN orders ON c_custkey = o_custkey""")
def join_full(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = load(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    both = joins.join(c, s, (c.c_nationkey == s.s_nationkey) & (c.c_custkey == s.s_suppkey), "full")
    return joins.join(both, o, both.c_custkey == o.o_custkey, "full").select("c_custkey", "s_suppkey", "o_orderkey")


@query("join_anti", """
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def join_anti(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_name")
    o = load(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_custkey")
    return joins.join(c, o, c.c_custkey == o.o_custkey, "left_anti")


@query("join_broadcast", """
SELECT s_nationkey, round(sum(l_extendedprice), 4) AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey""")
def join_broadcast(spark, sf):
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_extendedprice")
    s = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return (joins.enrich(li, s, "l_suppkey", "inner")
            .groupBy("s_nationkey").agg(r(F.sum("l_extendedprice")).alias("revenue")))


@query("enrich_title", f"""
WITH {RATINGS_SQL},
top AS (SELECT item, count(*) AS n_users FROM ratings GROUP BY item
        ORDER BY n_users DESC, item LIMIT 20)
SELECT item, n_users, p_name AS title FROM top LEFT JOIN part ON item = p_partkey""")
def enrich_title(spark, sf):
    top = order.top_k(aggs.count_by(ratings(spark, sf), "item", out="n_users"), 20,
                      [("n_users", "desc"), "item"])
    titles = load(spark, sf, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("title"))
    return joins.enrich(top, titles, "item", "left")


@query("join_composite", f"""
WITH {RATINGS_SQL},
pick AS (SELECT DISTINCT user_id AS "user", CAST(json_extract(props, '$.k') AS BIGINT) AS item FROM events)
SELECT "user", item, rating FROM ratings JOIN pick USING ("user", item)""")
def join_composite(spark, sf):
    """Ratings joined on (user, item) with the pairs of an event's user and the number in its properties."""
    pick = load(spark, sf, "events").select(
        F.col("user_id").alias("user"), rows.json_field("props", "k bigint")["k"].cast("long").alias("item")).distinct()
    return ratings(spark, sf).select("user", "item", "rating").join(pick, ["user", "item"])


@query("join_sql", """
SELECT c.c_mktsegment AS segment, count(*) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderstatus = 'O' GROUP BY c.c_mktsegment""")
def join_sql(spark, sf):
    return spark.sql("""
        SELECT c.c_mktsegment AS segment, count(*) AS n_orders
        FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderstatus = 'O' GROUP BY c.c_mktsegment""",
                     orders=load(spark, sf, "orders"), customer=load(spark, sf, "customer"))


@query("join_left_where", """
SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey = 1""")
def join_left_where(spark, sf):
    c = load(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf, "nation")
    # The WHERE on the right side turns the outer join into an inner one.
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left").filter(n.n_regionkey == 1)
            .select("c_custkey", "n_name"))


@query("join_group_count", """
SELECT n_name, count(*) AS n_customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""")
def join_group_count(spark, sf):
    c = load(spark, sf, "customer").select("c_nationkey")
    n = load(spark, sf, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").groupBy("n_name") \
            .agg(F.count(F.lit(1)).alias("n_customers"))


_COGROUP_SQL = """
WITH t AS (
  SELECT o_custkey, 'left' AS side, o_orderkey AS v FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_custkey, 'right' AS side, o_orderkey AS v FROM orders WHERE o_orderstatus <> 'F'),
c AS (SELECT *, (row_number() OVER (PARTITION BY o_custkey, side ORDER BY v) - 1) // 1000 AS chunk FROM t)
SELECT o_custkey, side, chunk, count(*) AS n, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS items
FROM c GROUP BY o_custkey, side, chunk"""


@query("cogroup_lists", _COGROUP_SQL)
def cogroup_lists(spark, sf):
    o = load(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    res = joins.cogroup(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'"),
                        "o_custkey", "o_orderkey", "o_orderkey")
    return res.withColumn("items", F.array_join("items", ","))


# --- set operations ----------------------------------------------------------------

@query("set_union", """
SELECT c_nationkey AS nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier
UNION ALL SELECT n_nationkey FROM nation""")
def set_union(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nationkey"))
    n = load(spark, sf, "nation").select(F.col("n_nationkey").alias("nationkey"))
    return joins.union_all(c, s, n)


@query("set_intersect", """
SELECT c_nationkey AS nationkey FROM customer WHERE c_acctbal > 9000
INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000""")
def set_intersect(spark, sf):
    c = load(spark, sf, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nationkey"))
    return joins.intersect(c, s)


@query("set_subtract", """
SELECT c_nationkey AS nationkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal > 5000 AND s_nationkey IS NOT DISTINCT FROM c.c_nationkey)""")
def set_subtract(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_nationkey").alias("nationkey"))
    s = load(spark, sf, "supplier").filter("s_acctbal > 5000").select(F.col("s_nationkey").alias("nationkey"))
    return joins.subtract(c, s)


# --- aggregations -------------------------------------------------------------------

@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, sf):
    return load(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("agg_reduce", "SELECT round(sum(l_quantity), 4) AS total FROM lineitem")
def agg_reduce(spark, sf):
    return load(spark, sf, "lineitem").agg(r(F.sum("l_quantity")).alias("total"))


@query("agg_stats", """
SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 6) AS mean,
       round(stddev_pop(l_extendedprice), 6) AS stdev, min(l_extendedprice) AS min,
       max(l_extendedprice) AS max, round(sum(l_extendedprice), 6) AS sum
FROM lineitem""")
def agg_stats(spark, sf):
    return aggs.stats(load(spark, sf, "lineitem"), "l_extendedprice", population=True)


@query("distinct_one", "SELECT DISTINCT l_returnflag FROM lineitem")
def distinct_one(spark, sf):
    return aggs.distinct(load(spark, sf, "lineitem"), ["l_returnflag"])


@query("distinct_many", "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem")
def distinct_many(spark, sf):
    return aggs.distinct(load(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_tax"])


@query("agg_count_distinct", f"""
WITH {RATINGS_SQL}
SELECT count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items, count(*) AS n_ratings
FROM ratings""")
def agg_count_distinct(spark, sf):
    pairs = stage(rating_pairs(spark, sf), "rating-pairs")  # the narrow fact, derived once
    n = pairs.agg(F.count(F.lit(1)).alias("n_ratings"))
    return aggs.count_distinct(pairs, {"n_users": "user", "n_items": "item"}).withColumn("_k", F.lit(1)) \
        .join(n.withColumn("_k", F.lit(1)), "_k").drop("_k")


@query("group_lists", """
WITH c AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                  (row_number() OVER (PARTITION BY l_returnflag
                     ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) - 1) // 1000 AS chunk
           FROM lineitem)
SELECT l_returnflag, chunk, count(*) AS n, round(list_sum(list(l_quantity)), 4) AS total,
       min(l_orderkey) AS first_order, max(l_orderkey) AS last_order
FROM c GROUP BY l_returnflag, chunk""")
def group_lists(spark, sf):
    """Whole line items, listed by flag in chunks of 1,000 in key order."""
    li = load(spark, sf, "lineitem").withColumn("line", F.struct("l_orderkey", "l_quantity"))
    res = aggs.group_lists(li, ["l_returnflag"], "line",
                           order=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], chunk=1000)
    return res.select("l_returnflag", "chunk", "n",
                      r(F.aggregate("items", F.lit(0.0), lambda a, x: a + x["l_quantity"])).alias("total"),
                      F.array_min("items")["l_orderkey"].alias("first_order"),
                      F.array_max("items")["l_orderkey"].alias("last_order"))


@query("reduce_by_key", """
SELECT l_suppkey, round(sum(l_quantity), 4) AS total FROM lineitem GROUP BY l_suppkey""")
def reduce_by_key(spark, sf):
    res = aggs.reduce_by_key(load(spark, sf, "lineitem"), "l_suppkey", "l_quantity")
    return res.withColumn("total", r("total"))


@query("mean_by_key", """
SELECT l_partkey, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_partkey""")
def mean_by_key(spark, sf):
    return aggs.mean_by_key(load(spark, sf, "lineitem"), "l_partkey", "l_quantity")


@query("count_by_key", "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey")
def count_by_key(spark, sf):
    return aggs.count_by(load(spark, sf, "orders"), "o_custkey")


@query("count_by_value", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def count_by_value(spark, sf):
    return aggs.count_by(load(spark, sf, "events"), "event_type")


@query("group_count_1", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def group_count_1(spark, sf):
    return load(spark, sf, "lineitem").groupBy("l_returnflag").count()


@query("group_count_2", """
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_count_2(spark, sf):
    return spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS count FROM {t} "
                     "GROUP BY l_returnflag, l_linestatus", t=load(spark, sf, "lineitem"))


@query("crosstab", """
SELECT l_returnflag AS l_returnflag_l_linestatus,
       count(*) FILTER (WHERE l_linestatus = 'F') AS "F",
       count(*) FILTER (WHERE l_linestatus = 'O') AS "O"
FROM lineitem GROUP BY l_returnflag""")
def crosstab(spark, sf):
    return aggs.crosstab(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("pair_counts", """
SELECT p_type, p_size, count(*) AS count FROM part GROUP BY p_type, p_size""")
def pair_counts(spark, sf):
    return aggs.pair_counts(load(spark, sf, "part"), "p_type", "p_size")


@query("pivot_mean", """
SELECT o_orderpriority,
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), 4) AS "F",
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 4) AS "O",
       round(avg(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 4) AS "P"
FROM orders GROUP BY o_orderpriority""")
def pivot_mean(spark, sf):
    return aggs.pivot_mean(load(spark, sf, "orders"), "o_orderpriority", "o_orderstatus",
                           "o_totalprice")


@query("describe_col", """
SELECT * FROM (VALUES
  ('count', (SELECT CAST(count(c_acctbal) AS DOUBLE) FROM customer)),
  ('mean', (SELECT round(avg(c_acctbal), 4) FROM customer)),
  ('stddev', (SELECT round(stddev_samp(c_acctbal), 4) FROM customer)),
  ('min', (SELECT min(c_acctbal) FROM customer)),
  ('max', (SELECT max(c_acctbal) FROM customer))) AS t(summary, value)""")
def describe_col(spark, sf):
    return aggs.describe(load(spark, sf, "customer"), "c_acctbal")


@query("global_min", "SELECT min(c_acctbal) AS min_acctbal FROM customer")
def global_min(spark, sf):
    return load(spark, sf, "customer").groupBy().min("c_acctbal") \
        .withColumnRenamed("min(c_acctbal)", "min_acctbal")


@query("observe_metrics", """
SELECT round(sum(value), 4) AS total, count(*) AS n, round(sum(value) / count(*), 6) AS mean,
       count(*) FILTER (WHERE event_type = 'error') AS n_errors
FROM events""")
def observe_metrics(spark, sf):
    """Accumulator-style totals (sum, count -> mean, error counter) as one
    aggregate pass.  (``aggs.observed`` attaches the same metrics to another
    job; it is not used here because Spark 4.1 sessions that have used
    ``observe`` can no longer serialise ML training summaries.)"""
    e = load(spark, sf, "events")
    return e.agg(r(F.sum("value")).alias("total"), F.count(F.lit(1)).alias("n"),
                 r(F.sum("value") / F.count(F.lit(1)), 6).alias("mean"),
                 F.count_if(F.col("event_type") == "error").alias("n_errors"))


@query("count_if_two", """
SELECT count(*) FILTER (WHERE contains(text, 'the')) AS n_the,
       count(*) FILTER (WHERE contains(text, 'und')) AS n_und
FROM documents""")
def count_if_two(spark, sf):
    d = load(spark, sf, "documents")
    return aggs.count_if_many(d, {"n_the": d.text.contains("the"), "n_und": d.text.contains("und")})


# --- sorting, top-k, look-ups ---------------------------------------------------------

@query("sort_key", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS position FROM orders""")
def sort_key(spark, sf):
    return order.sort(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                      [("o_orderkey", "desc")], "position")


@query("sort_value", """
SELECT l_suppkey, revenue, row_number() OVER (ORDER BY revenue DESC, l_suppkey) - 1 AS position
FROM (SELECT l_suppkey, round(sum(l_extendedprice), 4) AS revenue FROM lineitem GROUP BY l_suppkey)""")
def sort_value(spark, sf):
    li = load(spark, sf, "lineitem")
    rev = li.groupBy("l_suppkey").agg(r(F.sum("l_extendedprice")).alias("revenue"))
    return order.sort(rev, [("revenue", "desc"), "l_suppkey"], "position")


@query("top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k(spark, sf):
    return order.top_k(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                       [("o_totalprice", "desc"), "o_orderkey"])


@query("bottom_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10""")
def bottom_k(spark, sf):
    return order.top_k(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10,
                       ["o_totalprice", "o_orderkey"])


@query("sort_multi", """
SELECT o_orderpriority, o_totalprice, o_orderkey,
       row_number() OVER (ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) - 1 AS position FROM orders""")
def sort_multi(spark, sf):
    o = load(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    return order.sort(o, ["o_orderpriority", ("o_totalprice", "desc"), "o_orderkey"], "position")


@query("secondary_sort", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, row_number() OVER (
  ORDER BY l_quantity DESC, l_extendedprice DESC, l_orderkey, l_linenumber) - 1 AS position FROM lineitem""")
def secondary_sort(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return order.secondary_sort(li, [("l_quantity", "desc"), ("l_extendedprice", "desc"), "l_orderkey", "l_linenumber"],
                                position="position")


@query("take_n", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def take_n(spark, sf):
    return order.top_k(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), 5, ["o_orderkey"])


@query("lookup_key", "SELECT o_orderkey FROM orders WHERE o_custkey = 1")
def lookup_key(spark, sf):
    return order.lookup(load(spark, sf, "orders"), "o_custkey", 1, ["o_orderkey"])


@query("collect_map", """
SELECT string_agg(l_returnflag || '=' || CAST(n AS VARCHAR), ',' ORDER BY l_returnflag) AS m
FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY l_returnflag)""")
def collect_map(spark, sf):
    counts = aggs.count_by(load(spark, sf, "lineitem"), "l_returnflag", out="n")
    return order.as_map(counts, "l_returnflag", "n").select(order.map_text("m").alias("m"))


# --- splits -----------------------------------------------------------------------------

@query("random_split")
def random_split(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return splits.random_split(o, [8.0, 1.0, 1.0], seed=42)


@query("random_split_holds", """
SELECT split, true AS near_share, (SELECT count(*) FROM orders) AS n_all, (SELECT count(*) FROM orders) AS n_keys
FROM (VALUES (0), (1), (2)) t(split)""")
def random_split_holds(spark, sf):
    """Every row is in exactly one part, and each part has about its share."""
    drawn = stage(splits.random_split(load(spark, sf, "orders").select("o_orderkey"), [8.0, 1.0, 1.0], seed=42), "drawn")
    n = drawn.agg(F.count(F.lit(1)).alias("n_all"), F.count_distinct("o_orderkey").alias("n_keys")).withColumn("_k", F.lit(1))
    parts = drawn.groupBy("split").agg(F.count(F.lit(1)).alias("n")).withColumn("_k", F.lit(1)).join(n, "_k")
    share = F.when(F.col("split") == 0, 0.8).otherwise(0.1)
    return parts.select("split", (F.abs(F.col("n") / F.col("n_all") - share) < 0.03).alias("near_share"), "n_all", "n_keys")


@query("hash_split", """
SELECT o_orderkey,
       CASE WHEN ((o_orderkey * 2654435761 + 12345) % 4294967296) % 100 < 80 THEN 0
            WHEN ((o_orderkey * 2654435761 + 12345) % 4294967296) % 100 < 90 THEN 1 ELSE 2 END AS split
FROM orders""")
def hash_split(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey")
    return splits.hash_split(o, "o_orderkey", [8.0, 1.0, 1.0])


@query("kfold_slices", f"""
WITH {RATINGS_SQL}
SELECT "user", item, rating,
       CAST(floor((row_number() OVER (ORDER BY "user", item) - 1) * 5 / count(*) OVER ()) AS INTEGER) AS fold
FROM ratings""")
def kfold_slices(spark, sf):
    """Contiguous folds of whole ratings (payload columns included)."""
    return splits.kfold(stage(ratings(spark, sf), "ratings"), ["user", "item"], 5).drop("ts")


@query("leave_n_out", f"""
WITH {RATINGS_SQL}
SELECT "user", item,
       row_number() OVER (PARTITION BY "user" ORDER BY ts, item) BETWEEN 1 AND 10 AS is_test
FROM ratings""")
def leave_n_out(spark, sf):
    rt = ratings(spark, sf).select("user", "item", "ts")
    return splits.leave_n_out(rt, "user", ["ts", "item"], ["user", "item"], 1, 10).drop("ts")


@query("partition_count", "SELECT 8 AS n_partitions, count(*) AS n_rows FROM lineitem")
def partition_count(spark, sf):
    li = load(spark, sf, "lineitem").select("l_orderkey").repartition(8)
    per = li.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).cast("int").alias("n_partitions"), F.sum("n").alias("n_rows"))
