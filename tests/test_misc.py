from collections.abc import Iterator

import pandas as pd
import pytest
from pyspark.ml import feature as mf
from pyspark.sql import Row
from pyspark.sql import functions as F

from tablework.ml import models, recommend
from tablework.session import scratch_path
from tablework.sources import io

from .conftest import rows


def test_row_reflection_and_pandas(spark):
    person = Row("name", "age")
    df = spark.createDataFrame([person("ann", 30), person("bob", 41)])
    assert rows(df.filter("age > 35")) == [("bob", 41)]
    pdf = pd.DataFrame({"x": [1, 2, 3]})
    assert rows(spark.createDataFrame(pdf)) == [(1,), (2,), (3,)]
    assert len(io.bounded_pandas(spark.range(100), 100)) == 100
    with pytest.raises(ValueError, match="more than 5"):
        io.bounded_pandas(spark.range(100), 5)


def test_checkpoint_folder_rule(spark, tmp_path):
    """A cluster session without a shared folder is refused; what was written can be cleared."""
    from tablework import session
    assert session.is_local("local[4]") and session.is_local("local")
    assert not session.is_local("local-cluster[3,2,1000]") and not session.is_local("spark://host:7077")

    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

            class _Conf:
                get = staticmethod(lambda key, default=None: default)
            getConf = staticmethod(lambda: Bare.sparkContext._Conf)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Bare)
    kept, session._SCRATCH[:] = list(session._SCRATCH), []
    df = session.stage(spark.range(7), "rule")
    assert df.count() == 7 and session.clear_scratch(spark) == 1
    session._SCRATCH[:] = kept


def test_staged_rows_of_a_task_are_bounded(spark):
    """With a bound the staged files, and the tasks that read them, do not grow with the table."""
    from tablework import session

    df = spark.range(0, 95, 1, 1)
    got = session.stage(df, "bounded", most=10)
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 10 and max(sizes) == 10 and sorted(r["id"] for r in got.collect()) == list(range(95))
    assert got.sparkSession.conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(16 << 20)


def test_als_takes_ids_beyond_32_bits(spark):
    big = 3_000_000_000
    data = [(big + u, f"item{i}", float((u * i) % 5)) for u in range(6) for i in range(5)]
    rt = spark.createDataFrame(data, "user_id long, item_id string, rating float")
    users, items = recommend.index_ids(rt, "user_id", "user"), recommend.index_ids(rt, "item_id", "item")
    numbered = recommend.with_ids(rt, users, items)
    model = recommend.als(rank=2, max_iter=2).fit(numbered)
    scored = model.transform(numbered).select("user_id", "item_id", "prediction")
    assert scored.count() == 30 and scored.agg({"user_id": "max"}).first()[0] == big + 5


@pytest.mark.parametrize("name", ["als_fit", "als_rmse"])
def test_als_queries_take_great_keys(spark, tmp_path, name):
    """Customer numbers from 438,000 on overflowed the split of the pairs."""
    from tablework.plans import QUERIES

    big = 3_000_000_000_000_000
    orders = [(big + n, big + n % 7, "2024-01-01 00:00:00") for n in range(40)]
    lines = [(big + n, big + (n * 3 + k) % 9, float((n * k) % 5 + 1)) for n in range(40) for k in range(3)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    pairs = {(big + n % 7, big + (n * 3 + k) % 9) for n in range(40) for k in range(3)}
    split = {p: ((p[0] * 7919 + p[1]) * 2654435761 + 12345) % 2**32 % 10 < 8 for p in pairs}
    got = QUERIES[name](spark, str(tmp_path))
    if name == "als_fit":
        assert {(r["user"], r["item"]) for r in got.collect()} == pairs
    else:
        assert got.first()["n_scored"] == sum(not train for train in split.values()) > 0


def test_als_tune_has_blocks_for_its_ratings(spark, tmp_path, monkeypatch):
    """A block is a task's memory, so their number grows with the ratings; ten are enough for few."""
    from tablework.plans import QUERIES, q_models

    spark.createDataFrame([(n, n % 7, "2024-01-01") for n in range(40)], "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(n, n, 1.0 + n % 5) for n in range(40)], "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")

    class Seen(Exception):
        pass

    def tvs(stages, est, *rest):
        raise Seen(est.getNumUserBlocks(), est.getNumItemBlocks())

    monkeypatch.setattr(q_models.tuning, "tvs", tvs)
    for ratings, blocks in ((recommend.BLOCK_RATINGS, 10), (3, 14)):
        monkeypatch.setattr(recommend, "BLOCK_RATINGS", ratings)
        with pytest.raises(Seen) as seen:
            QUERIES["als_tune"](spark, str(tmp_path))
        assert seen.value.args == (blocks, blocks)


def test_foreach_partition_side_effect(spark):
    acc = spark.sparkContext.accumulator(0)

    def count_rows(it):
        n = 0
        for _ in it:
            n += 1
        acc.add(n)

    spark.range(0, 50, numPartitions=4).foreachPartition(count_rows)
    assert acc.value == 50


def test_model_save_load_and_explain(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 5.0, 1.0), (0.0, 2.0, 0.0), (1.0, 6.0, 1.0)],
                               "a double, b double, label double")
    stages = [mf.VectorAssembler(inputCols=["a", "b"], outputCol="features"),
              models.estimator("tree_classifier", maxDepth=2, seed=1)]
    model, pred = models.fit_predict(stages, df)
    path = scratch_path(spark, "model")
    models.save(model, path)
    back = models.load_pipeline(path)
    assert rows(back.transform(df).select("prediction")) == rows(pred.select("prediction"))
    assert "If (feature" in models.explain(model.stages[-1])
    imp = models.importances(spark, model.stages[-1], ["a", "b"])
    assert abs(sum(r["importance"] for r in imp.collect()) - 1.0) < 1e-9


def test_lines_of_many_keys_take_few_groups(spark, monkeypatch):
    """The groups of the map are bounded, however many keys there are; few waiting sums give the same lines."""
    from tablework.operators import udfs

    df = spark.range(2000).select((F.col("id") % 500).alias("k"), (F.col("id") / 500).cast("int").alias("x"),
                                  ((F.col("id") / 500).cast("int") * 2 + F.col("id") % 500).alias("y"))
    grouped, groups = udfs.apply_grouped_batches, []
    sums = udfs.line_sums
    monkeypatch.setattr(udfs, "apply_grouped_batches", lambda d, keys, *a: (groups.append(d.select(*keys).distinct().count()), grouped(d, keys, *a))[1])
    for most in (100_000, 3):
        monkeypatch.setattr(udfs, "line_sums", lambda *a: sums(*a, most))
        got = {r["k"]: (r["n"], r["slope"], r["intercept"]) for r in udfs.fit_lines(df, "k", "x", "y").collect()}
        assert got == {k: (4, pytest.approx(2.0), pytest.approx(k, abs=1e-9)) for k in range(500)}
    assert max(groups) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = 2**60
    few = spark.createDataFrame([(k, x, 2 * x + 1) for k in (big, big + 1, None) for x in (1, 2)], "k long, x int, y int")
    got = {r["k"]: r["n"] for r in udfs.fit_lines(few, "k", "x", "y", 1).collect()}
    assert got == {big: 2, big + 1: 2, None: 2}


def test_grouped_map_streams_a_group_in_batches(spark):
    """A key with most of the rows comes in several batches; lines are exact, null keys are a group, a constant x has no slope."""
    from tablework.operators import udfs

    data = [("hot", float(i), 3.0 * i - 7) for i in range(500)] + [(None, 1.0, 2.0), (None, 2.0, 5.0), ("flat", 4.0, 1.0), ("flat", 4.0, 2.0), ("gone", None, 1.0)]
    side = spark.newSession()
    side.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    df = side.createDataFrame(data, "k string, x double, y double")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = [len(b) for b in batches]
        yield pd.DataFrame({"batches": [len(sizes)], "most": [max(sizes)]})

    seen = udfs.apply_grouped_batches(df, ["k"], count, "batches long, most long").collect()
    assert max(r["batches"] for r in seen) >= 10 and max(r["most"] for r in seen) <= 50
    want = {"hot": (500, 3.0, -7.0), None: (2, 3.0, -1.0), "flat": (2, None, None)}
    for parts in (1, 8):
        got = {r["k"]: (r["n"], r["slope"], r["intercept"]) for r in udfs.fit_lines(df, "k", "x", "y", parts).collect()}
        assert got.keys() == want.keys() and got[None] == pytest.approx(want[None]) and got["flat"] == want["flat"]
        assert got["hot"] == pytest.approx(want["hot"])
