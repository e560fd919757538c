"""Source, sink and catalog queries.

Round trips write to a fresh folder under the shared checkpoint folder and
scan the files back, so the value checked is what the reader produced.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..functions.common import r
from ..session import scratch_path, stage
from ..sources import catalog, io
from ..tables import load, path
from .registry import query


@query("src_collection", """
SELECT range AS id FROM range((SELECT min(c_custkey) FROM customer), (SELECT max(c_custkey) + 1 FROM customer))
WHERE range NOT IN (SELECT o_custkey FROM orders)""")
def src_collection(spark, sf):
    """A generated collection (``spark.range``) checked against a table: the
    customer-key range minus every key that placed an order."""
    lo, hi = load(spark, sf, "customer").agg(F.min("c_custkey"), F.max("c_custkey")).first()
    ids = spark.range(lo, hi + 1)
    o = load(spark, sf, "orders").select("o_custkey")
    return ids.join(o, ids.id == o.o_custkey, "left_anti")


@query("scan_parquet", """
SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'""")
def scan_parquet(spark, sf):
    li = io.read(spark, "parquet", path(sf, "lineitem"))
    return li.filter(F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")) \
             .select("l_orderkey", "l_quantity")


@query("sql_on_file", """
SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""")
def sql_on_file(spark, sf):
    return io.sql_on_file(spark, "parquet", path(sf, "customer"), "c_mktsegment, count(*) AS n",
                          where="c_acctbal > 0", tail="GROUP BY c_mktsegment")


@query("merge_schema", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price,
       CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderstatus ELSE 'other' END AS status
FROM orders""")
def merge_schema(spark, sf):
    """Partitions written with different columns, read back under one schema."""
    o = load(spark, sf, "orders")
    base = scratch_path(spark, "merge-schema")
    io.write(o.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("price")),
             "parquet", f"{base}/status=F")
    io.write(o.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey"),
             "parquet", f"{base}/status=O")
    io.write(o.filter("o_orderstatus NOT IN ('F', 'O')").select("o_orderkey", F.col("o_orderpriority").alias("priority")),
             "parquet", f"{base}/status=other")
    return io.read(spark, "parquet", base, mergeSchema="true") \
        .select("o_orderkey", "price", "o_custkey", "priority", "status")


@query("partition_roundtrip", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def partition_roundtrip(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    p = scratch_path(spark, "by-status")
    io.write(o, "parquet", p, partition_by=["o_orderstatus"])
    back = io.read(spark, "parquet", p)
    # Filter on the partition column: only the F and P folders are listed.
    return back.filter(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


def _roundtrip_query(name: str, fmt: str, table: str, cols: list[str], **opts):
    sql = f"SELECT {', '.join(cols)} FROM {table}"

    @query(name, sql)
    def q(spark, sf):
        df = load(spark, sf, table).select(*cols)
        return io.roundtrip(df, fmt, label=name, **opts)

    return q


_roundtrip_query("parquet_roundtrip", "parquet", "lineitem",
                 ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"])
_roundtrip_query("orc_roundtrip", "orc", "orders",
                 ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"])
_roundtrip_query("csv_roundtrip", "csv", "customer",
                 ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
                 read_options={"header": "true", "sep": "|"}, header="true", sep="|")
_roundtrip_query("json_roundtrip", "json", "events", ["event_id", "user_id", "event_type", "value", "props"])


@query("text_roundtrip", """
SELECT unnest(string_split(text, chr(10))) AS value FROM documents""")
def text_roundtrip(spark, sf):
    lines = F.explode(F.split(F.col("text"), "\n")).alias("value")
    docs = load(spark, sf, "documents").select(lines)
    p = scratch_path(spark, "text-lines")
    io.write(docs, "text", p, lineSep="\n")
    return io.read(spark, "text", p, lineSep="\n")


_TYPED_COLS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query("typed_from_lines", """
SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem""")
def typed_from_lines(spark, sf):
    li = load(spark, sf, "lineitem")
    lines = io.to_lines(li, _TYPED_COLS, "|")
    schema = li.select(*_TYPED_COLS).schema
    return io.parse_lines(lines, schema, "|")


@query("bucketed_table", """
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 4) AS total
FROM orders GROUP BY o_custkey""")
def bucketed_table(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    name = catalog.unique_name("orders_bucketed")
    io.write(o, "parquet", scratch_path(spark, name), mode="error", bucket_by=(8, ["o_custkey"]),
             sort_by=["o_orderkey"], table=name)
    t = spark.table(name)
    # Grouping on the bucket column reuses the bucket layout: no exchange.
    return t.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                      r(F.sum("o_totalprice"), 4).alias("total"))


@query("custom_partition", """
SELECT ((o_orderkey % 10) + 10) % 10 AS part, count(*) AS n FROM orders GROUP BY 1""")
def custom_partition(spark, sf):
    o = io.key_partition(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 10)
    p = scratch_path(spark, "key-mod-10")
    io.write(o, "parquet", p, partition_by=["part"])
    back = io.read(spark, "parquet", p)
    return back.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("sql_view", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal
FROM customer GROUP BY c_mktsegment""")
def sql_view(spark, sf):
    name = catalog.temp_view(load(spark, sf, "customer"), catalog.unique_name("customer_v"))
    return spark.sql(f"SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS avg_bal "
                     f"FROM {name} GROUP BY c_mktsegment")


@query("global_view", """
SELECT n_regionkey, count(*) AS n_customers
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey""")
def global_view(spark, sf):
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"),
                                         F.col("c_nationkey") == F.col("n_nationkey"))
    qualified = catalog.global_view(c, catalog.unique_name("cust_nation"))
    other = spark.newSession()  # a second session sees the global view
    return other.sql(f"SELECT n_regionkey, count(*) AS n_customers FROM {qualified} GROUP BY n_regionkey")


@query("catalog_refresh", """
SELECT o_orderstatus, count(*) AS n, true AS listed FROM orders GROUP BY o_orderstatus""")
def catalog_refresh(spark, sf):
    """A listed table to whose folder another writer adds files: after a refresh its rows are all there."""
    o = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    name = catalog.unique_name("orders_growing")
    p = scratch_path(spark, name)
    io.write(o.filter("o_orderstatus = 'F'"), "parquet", p, mode="error", table=name)
    spark.table(name).count()  # the table's files are known from now on
    io.write(o.filter("o_orderstatus != 'F'"), "parquet", p, mode="append")
    catalog.refresh(spark, name)
    listed = name in catalog.list_tables(spark)
    return spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("listed", F.lit(listed))


@query("persist_levels", """
SELECT c_mktsegment, level, count(*) AS n, round(sum(c_acctbal), 4) AS total, true AS cached_inside, false AS cached_after
FROM customer, (SELECT unnest(['DISK_ONLY', 'MEMORY_AND_DISK', 'MEMORY_ONLY']) AS level) GROUP BY 1, 2""")
def persist_levels(spark, sf):
    """Two passes over a persisted table at each level; it is cached inside the block and not after it."""
    out = None
    for level in ("DISK_ONLY", "MEMORY_AND_DISK", "MEMORY_ONLY"):
        kept = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
        with catalog.persisted(kept, getattr(StorageLevel, level)) as c:
            inside = c.is_cached and c.storageLevel == getattr(StorageLevel, level)
            n = c.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
            total = c.groupBy("c_mktsegment").agg(r(F.sum("c_acctbal")).alias("total"))
            done = stage(n.join(total, "c_mktsegment").withColumn("level", F.lit(level)).withColumn("cached_inside", F.lit(inside)), "persisted")
        done = done.withColumn("cached_after", F.lit(kept.is_cached))
        out = done if out is None else out.unionByName(done)
    return out
