import pytest
from pyspark.sql import functions as F

from tablework.operators import aggs, joins, order, rows as rowops, splits, udfs

from .conftest import rows


def pairs(spark, data):
    return spark.createDataFrame(data, "k long, v long")


def test_pair_operators(spark):
    paid = pairs(spark, [(7, 10), (8, 1), (7, 5), (9, 2), (7, -3)])
    due = spark.createDataFrame([(7, 100), (9, 50), (4, 9)], "k long, w long")
    assert rows(aggs.reduce_by_key(paid, "k", "v")) == [(7, 12), (8, 1), (9, 2)]
    assert rows(joins.join(paid, due, "k")) == [(7, -3, 100), (7, 5, 100), (7, 10, 100), (9, 2, 50)]
    left = rows(joins.join(paid, due, "k", "left"), "k", "v", "w")
    assert left == [(7, -3, 100), (7, 5, 100), (7, 10, 100), (8, 1, None), (9, 2, 50)]
    assert rows(joins.join(paid, due, "k", "left_anti")) == [(8, 1)]
    assert rows(aggs.count_by(paid, "k")) == [(7, 3), (8, 1), (9, 1)]
    assert sorted(r["v"] for r in order.lookup(paid, "k", 7).collect()) == [-3, 5, 10]


def test_set_operators(spark):
    def bag(*xs):
        return spark.createDataFrame([(x,) for x in xs], "x long")

    assert joins.union_all(bag(1, 1), bag(1), bag(8, 9)).count() == 5
    assert rows(joins.intersect(bag(4, 4, 6, 7), bag(4, 7, 7, 0))) == [(4,), (7,)]
    assert rows(joins.subtract(bag(4, 4, 6, 6, 7), bag(4, 9))) == [(6,), (6,), (7,)]  # repeats stay


def test_subtract_null_safe(spark):
    a = spark.createDataFrame([(None,), (1,)], "x long")
    b = spark.createDataFrame([(None,)], "x long")
    assert rows(joins.subtract(a, b)) == [(1,)]


def test_population_stats(spark):
    df = spark.createDataFrame([(float(x),) for x in (3, 7, 7, 19)], "x double")
    s = aggs.stats(df, "x").first()
    assert (s["count"], s["mean"], s["max"], s["min"], s["sum"]) == (4, 9.0, 19.0, 3.0, 36.0)
    assert s["stdev"] == 6.0  # squares 36 + 4 + 4 + 100 over 4


def test_mean_by_key_and_observation(spark):
    df = spark.createDataFrame([("oak", 3), ("elm", 8), ("oak", 4), ("elm", 9), ("oak", 11)], "k string, v long")
    assert rows(aggs.mean_by_key(df, "k", "v")) == [("elm", 8.5), ("oak", 6.0)]
    side = spark.newSession()  # keep the observation manager out of the shared session
    nums = side.range(1, 101)
    watched, obs = aggs.observed(nums, "acc", {"total": F.sum("id"), "n_even": F.count_if(F.col("id") % 2 == 0)})
    watched.write.format("noop").mode("overwrite").save()
    assert obs.get["total"] == 5050 and obs.get["n_even"] == 50


def test_grouped_map_center(spark):
    df = spark.createDataFrame([(4, 10.0), (4, 30.0), (6, 1.0), (6, 1.0), (6, 7.0)], ("id", "v"))
    want = [(4, -10.0), (4, 10.0), (6, -2.0), (6, -2.0), (6, 4.0)]
    assert rows(udfs.center_by_group(df, "id", "v")) == want
    got = udfs.apply_grouped(df, ["id"], udfs.subtract_mean, "id long, v double")
    assert rows(got) == want


def test_pandas_multiply(spark):
    df = spark.createDataFrame([(-2, 9), (5, 5)], "x long, z long")
    assert rows(df.select(udfs.multiply()("x", "z").alias("y"))) == [(-18,), (25,)]


def test_per_partition_reports_each_partition(spark):
    import pandas as pd

    def report(batches):
        yield pd.DataFrame({"n": [sum(len(b) for b in batches)]})

    got = udfs.per_partition(spark.range(0, 50, numPartitions=4), report, "n long")
    assert got.count() == 4 and got.agg(F.sum("n")).first()[0] == 50


def test_ordered_index_matches_row_number(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000).repartition(7)
    idx = splits.ordered_index(df, ["k"], "i", partitions=5)
    got = sorted((r["k"], r["i"], r["id"] * 7919 % 1000) for r in idx.collect())
    assert got == [(k, k, k) for k in range(1000)]


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ordered_index_with_payload_is_exact(spark, reuse):
    """A million rows with columns that are not in the key, with and without exchange reuse."""
    n = 1_000_000
    df = (spark.range(0, n).withColumn("k", F.xxhash64("id")).withColumn("note", F.concat(F.lit("row "), "id"))
          .withColumn("x", F.rand(3)))
    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        idx = splits.ordered_index(df, ["k"], "i", with_total="n")
        low, high, distinct, rows_, total = idx.agg(F.min("i"), F.max("i"), F.count_distinct("i"), F.count(F.lit(1)), F.max("n")).first()
        folds = {r["fold"]: r["count"] for r in splits.kfold(df, ["k"], 5).groupBy("fold").count().collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
    assert (low, high, distinct, rows_, total) == (0, n - 1, n, n, n)
    assert folds == {i: n // 5 for i in range(5)}


def test_ordered_index_keys_with_nulls_and_text(spark):
    df = spark.createDataFrame([("b", 2), (None, 1), ("b", 1), ("a", 9), (None, 0)], "k string, v long")
    idx = splits.ordered_index(df, ["k", "v"], "i", partitions=3)
    got = [(r["k"], r["v"]) for r in sorted(idx.collect(), key=lambda r: r["i"])]
    assert got == [(None, 0), (None, 1), ("a", 9), ("b", 1), ("b", 2)]
    assert splits.ordered_index(df.limit(0), ["k"], "i").count() == 0


def test_running_sum(spark):
    df = spark.range(0, 500).withColumn("v", F.col("id") % 7)
    got = {r["id"]: r["before"] for r in splits.running_sum(df, "id", "v", "before", partitions=6).collect()}
    assert got == {i: sum(j % 7 for j in range(i)) for i in range(500)}


def test_random_split_labels_each_row_once(spark):
    got = splits.random_split(spark.range(0, 4000), [3.0, 1.0], seed=9)
    n = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert sum(n.values()) == 4000 and 2800 < n[0] < 3200


def test_kfold_disjoint_and_covering(spark):
    df = spark.range(0, 103)
    f = splits.kfold(df, ["id"], 5)
    got = {r["id"]: r["fold"] for r in f.collect()}
    assert len(got) == 103 and set(got.values()) == {0, 1, 2, 3, 4}
    # contiguous slices of the order
    assert all(got[i] <= got[i + 1] for i in range(102))


def test_leave_n_out(spark):
    data = [(u, i, i) for u in range(5) for i in range(25 if u else 8)]
    df = spark.createDataFrame(data, "user long, item long, ts long")
    a = splits.leave_n_out(df, "user", ["ts", "item"], ["user", "item"], 1, 10)
    b = splits.leave_n_out(df, "user", ["ts", "item"], ["user", "item"], 11, 20)
    ta = {(r["user"], r["item"]) for r in a.filter("is_test").collect()}
    tb = {(r["user"], r["item"]) for r in b.filter("is_test").collect()}
    assert not ta & tb
    for u in range(1, 5):
        assert sum(1 for x in ta if x[0] == u) == 10
    assert sum(1 for x in ta if x[0] == 0) == 8
    assert a.count() == df.count()


def test_hash_bucket_of_any_key(spark):
    """A key whose product with the multiplier is beyond 64 bits has the bucket of the exact product."""
    keys = [0, 1, -1, 65_536, 2**32 - 1, -(2**32), 900_000 * 7919 + 1_200_000, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k long").select("k", splits.hash_bucket("k", 10).alias("b"))
    assert {r["k"]: r["b"] for r in df.collect()} == {None: None, **{k: (k * 2654435761 + 12345) % 2**32 % 10 for k in keys}}


def test_hash_split_stable_across_partitioning(spark):
    df = spark.range(0, 5000)
    s1 = {r["id"]: r["split"] for r in splits.hash_split(df.repartition(3), "id", [8, 1, 1]).collect()}
    s2 = {r["id"]: r["split"] for r in splits.hash_split(df.repartition(11), "id", [8, 1, 1]).collect()}
    assert s1 == s2
    share = sum(1 for v in s1.values() if v == 0) / len(s1)
    assert 0.75 < share < 0.85


def test_group_lists_chunks_are_bounded(spark):
    df = spark.range(0, 2500).withColumn("g", F.when(F.col("id") < 2300, 0).otherwise(1)).withColumn("pay", F.rand(1))
    out = aggs.group_lists(df, ["g"], "id", chunk=500).collect()
    assert max(r["n"] for r in out) <= 500
    hot = sorted((r for r in out if r["g"] == 0), key=lambda r: r["chunk"])
    assert [r["chunk"] for r in hot] == [0, 1, 2, 3, 4]
    assert [x for r in hot for x in r["items"]] == list(range(2300))


def test_category_index_and_cells(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "c string")
    assert rows(rowops.category_index(df, "c")) == [("a", 0), ("a", 0), ("b", 1), ("c", 2)]
    wide = spark.createDataFrame([(1, "x", 5)], "id long, name string, n int")
    cells = rowops.wide_to_cells(wide, "id", ["name", "n"])
    assert rows(cells) == [("1", "cf", "n", "5"), ("1", "cf", "name", "x")]
    back = rowops.cells_to_wide(cells, "row", "column", "value", ["name", "n"])
    assert rows(back, "row", "name", "n") == [("1", "x", "5")]


def test_enrich_keeps_rows(spark):
    facts = spark.range(0, 100).withColumn("k", F.col("id") % 4)
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "k long, name string")
    got = joins.enrich(facts, dim, "k")
    assert got.count() == 100 and got.filter("name is null").count() == 25


def test_pivots_take_categories_from_the_data(spark):
    df = spark.createDataFrame([("x", "p", 1.0), ("x", "q", 3.0), ("y", "new", 5.0)], "a string, b string, v double")
    assert aggs.crosstab(df, "a", "b").columns == ["a_b", "new", "p", "q"]
    assert rows(aggs.pair_counts(df, "a", "b")) == [("x", "p", 1), ("x", "q", 1), ("y", "new", 1)]
    assert aggs.pivot_mean(df, "a", "b", "v").columns == ["a", "new", "p", "q"]


def test_count_distinct_and_bounded_map(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "x long, y string")
    assert rows(aggs.count_distinct(df, {"nx": "x", "ny": "y"}), "nx", "ny") == [(2, 2)]
    with pytest.raises(ValueError, match="keys"):
        order.as_map(spark.range(5).withColumn("v", F.lit(1)), "id", "v", max_keys=3)
