import os
import random
import time

import pandas as pd
from pyspark.sql import functions as F

from tablework.session import scratch_path
from tablework.streaming import panes, state, streams

from .conftest import SF_SMALL, rows


def test_late_data_trace(spark):
    """Watermark 30 minutes, half-hour windows, update mode; three arrivals of
    meter readings.  The third brings one reading that is still in time and
    two whose window has closed, which are dropped."""
    d = scratch_path(spark, "late-readings")
    os.makedirs(d, exist_ok=True)
    day = "2031-03-05"
    arrivals = [
        [("gas", "06:05"), ("gas", "06:25"), ("water", "06:40")],
        [("gas", "09:50"), ("water", "06:55"), ("gas", "07:10")],
        [("water", "09:35"), ("gas", "06:20"), ("water", "08:59")],
    ]
    src = streams.file_stream(spark, d, "csv", "word string, eventTime timestamp", sep=";")
    agg = streams.sliding_agg(src, "eventTime", ["word"], F.count(F.lit(1)).alias("count"), "30 minutes",
                              watermark="30 minutes")
    out = scratch_path(spark, "late-out")
    q, out = streams.run_stream(agg.select("word", streams.window_start().alias("start"), "count"), out,
                                "update", foreach_batch=streams.per_batch(lambda b: b, out),
                                trigger={"processingTime": "0 seconds"})
    try:
        for i, readings in enumerate(arrivals):
            with open(f"{d}/part-{i}.csv", "w") as f:
                f.write("".join(f"{m};{day} {t}:00\n" for m, t in readings))
            q.processAllAvailable()
    finally:
        q.stop()
    per_batch = {}
    for r in spark.read.parquet(out).collect():
        per_batch.setdefault(r["batch_id"], set()).add((r["word"], r["start"][11:16], r["count"]))
    seq = [per_batch[k] for k in sorted(per_batch) if per_batch[k]]
    # after the first arrival the watermark is 06:10, after the second 09:20
    assert seq == [
        {("gas", "06:00", 2), ("water", "06:30", 1)},
        {("gas", "09:30", 1), ("water", "06:30", 2), ("gas", "07:00", 1)},
        {("water", "09:30", 1)},
    ]


def test_batch_equals_stream(spark):
    ev = streams.table_stream(spark, SF_SMALL, "events", event_time="ts")
    got = streams.drain(ev.groupBy("event_type").count(), "complete")
    want = spark.read.parquet(f"{SF_SMALL}/events.parquet").groupBy("event_type").count()
    assert rows(got) == rows(want)


def test_table_in_several_files_streams_whole(spark, tmp_path):
    """A table that is a folder of files comes whole; a table beside it stays out."""
    data = spark.range(0, 40).select((F.col("id") % 4).alias("k"), F.col("id").alias("t"))
    data.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    data.write.parquet(f"{tmp_path}/orders.parquet")
    counts = streams.table_stream(spark, str(tmp_path), "events").groupBy("k").count()
    assert rows(streams.drain(counts, "update", keys=["k"])) == [(k, 10) for k in range(4)]
    got = streams.drain(streams.table_stream(spark, str(tmp_path), "events", max_files_per_trigger=1))
    assert sorted(r["t"] for r in got.collect()) == list(range(40))


def test_running_state_with_seed_and_restart(spark):
    data = spark.range(0, 40).select((F.col("id") % 4).alias("k"), F.col("id").alias("t"))
    d = streams.split_to_files(data, "t", 4)
    schema = spark.read.parquet(d).schema
    seed = spark.createDataFrame([(0, 100), (9, 5)], "k long, count long")
    ckpt = scratch_path(spark, "state-ckpt")
    out = scratch_path(spark, "state-out")
    src = streams.file_stream(spark, d, "parquet", schema, max_files_per_trigger=1).select("k")
    res = streams.drain(state.running_state(src, "k", "count", initial=seed), "update", keys=["k"],
                        out=out, checkpoint=ckpt)
    assert rows(res) == [(0, 110), (1, 10), (2, 10), (3, 10)]
    # the table of all keys: a seeded key without new rows keeps its seed
    assert rows(state.last_state(res, "k", "count", seed)) == [(0, 110), (1, 10), (2, 10), (3, 10), (9, 5)]
    # restart on the same checkpoint: nothing new, same table
    src2 = streams.file_stream(spark, d, "parquet", schema, max_files_per_trigger=1).select("k")
    res2 = streams.drain(state.running_state(src2, "k", "count", initial=seed), "update", keys=["k"],
                         out=out, checkpoint=ckpt)
    assert rows(res2) == rows(res)


def test_windows_by_inverse_match_brute_force_over_arrivals_and_restarts(spark):
    """Random readings in five arrivals (each a restart on one checkpoint): sums of windows of 40 s every 10 s, zeros
    where a meter falls silent, nothing behind the watermark, nothing of windows that are still open."""
    rng = random.Random(6)
    arrivals = [[(rng.choice(["gas", "water", None]), 1_900_000_000 + 200 * k + rng.choice([rng.randint(0, 190), rng.randint(-60, 190)]),
                  rng.randint(-9, 9)) for _ in range(25)] for k in range(5)]
    mark, kept = 0, []
    for some in arrivals:
        kept += [r for r in some if r[1] * 1000 >= mark]
        mark = max([mark, *(r[1] * 1000 - 20_000 for r in some)])
    want = []
    for meter in {r[0] for r in kept}:
        own = [r for r in kept if r[0] == meter]
        before = 0
        for start in range(1_899_999_900, 1_900_001_300, 10):
            inside = [r for r in own if start <= r[1] < start + 40]
            if (inside or before) and (start + 40) * 1000 <= mark:
                want.append((meter, start, len(inside), sum(r[2] for r in inside)))
            before = len(inside)
    side = state.state_session(spark)
    frames = [side.createDataFrame(some, "meter string, s long, v long").select("meter", F.timestamp_seconds("s").alias("ts"), "v") for some in arrivals]
    got = streams.drain_arrivals(side, frames, lambda src: panes.inverse_window(src, "meter", "ts", F.col("v"), 40, 10, "20 seconds"), "append")
    got = rows(got.select("meter", F.unix_seconds("window_start"), "n", "total"))
    assert got == sorted(want, key=lambda r: (r[0] is None, r[0] or "", r[1:]))
    assert any(r[2] == 0 for r in got) and len(kept) < 125


def test_windows_by_inverse_ask_the_store_once_for_all_panes():
    """A key with rows in many panes reads and writes its state once in a batch, and once when its windows come out."""
    class Store:
        calls, value = 0, None

        def exists(self):
            return self.value is not None

        def get(self):
            Store.calls += 1
            return self.value

        def update(self, value):
            Store.calls += 1
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return Store()

        def getMapState(self, name, schema):
            raise AssertionError("a call for each pane")

        def registerTimer(self, at):
            self.timer = at

    class Mark:
        def __init__(self, at):
            self.getCurrentWatermarkInMs = lambda: at

    own = panes.PaneWindow("k", 40, 10)
    own.init(Handle())
    list(own.handleInputRows(("a",), iter([pd.DataFrame({"at_ms": range(0, 1000, 5), "amount": [1] * 200})]), Mark(0)))
    list(own.handleInputRows(("a",), iter([pd.DataFrame({"at_ms": range(3, 1000, 5), "amount": [2] * 200})]), Mark(0)))
    got = next(own.handleExpiredTimer(("a",), Mark(500), None))
    assert Store.calls <= 5
    assert got["n"].tolist() == [4, 8, 12] + [16] * 47 and got["total"].tolist() == [6, 12, 18] + [24] * 47


def test_arrivals_of_text_grow_in_files_not_in_size(spark, tmp_path):
    """As many files as the table is read by tasks, in four batches."""
    from tablework import session
    from tablework.plans import QUERIES, q_streams

    assert [q_streams._files_per_batch(spark.range(0, 40, 1, n), 4) for n in (1, 4, 5, 16)] == [1, 1, 2, 4]
    data = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 3, F.lit(" a\nb")).alias("text"))
    data.repartition(10).write.parquet(f"{tmp_path}/documents.parquet")
    side = spark.newSession()
    for name, value in (("maxPartitionBytes", "1000"), ("openCostInBytes", "0")):
        side.conf.set(f"spark.sql.files.{name}", value)
    before = len(session._SCRATCH)
    got = QUERIES["stream_word_count_batch"](side, str(tmp_path))
    assert rows(got) == [("a", 200), ("b", 200), ("w0", 67), ("w1", 67), ("w2", 66)]
    made = next(p for p in session._SCRATCH[before:] if "text-arrivals" in p)
    assert side.read.text(made).select(F.input_file_name()).distinct().count() >= 10
    out = next(p for p in session._SCRATCH[before:] if "stream-out" in p)
    assert side.read.parquet(out).select("batch_id").distinct().count() == 4


def test_outer_stream_join_waits_for_the_watermark(spark):
    """Calls and answers within 10 minutes, watermark 5 minutes, three arrivals: a call without an answer comes out once its
    time is over, the last one is still waiting."""
    def at(kind, key, minute):
        return (kind, key, f"2031-03-05 {8 + minute // 60:02d}:{minute % 60:02d}:00")

    arrivals = [[at("call", 1, 0), at("call", 2, 1), at("answer", 9, 2)], [at("answer", 1, 8), at("call", 3, 20), at("answer", 8, 30)],
                [at("call", 4, 60), at("answer", 3, 58), at("answer", 4, 65), at("call", 5, 64)]]
    frames = [spark.createDataFrame(a, "kind string, k long, ts string").withColumn("ts", F.to_timestamp("ts")) for a in arrivals]

    def build(how):
        def made(src):
            calls, answers = (src.filter(F.col("kind") == x).select("k", "ts") for x in ("call", "answer"))
            j = streams.stream_join(calls, answers, "k", "ts", "ts", "10 MINUTES", "5 minutes", how)
            return j.select(F.col("l.k").alias("call"), F.col("r.k").alias("answer"))
        return made

    assert rows(streams.drain_arrivals(spark, frames, build("inner"), "append")) == [(1, 1), (4, 4)]
    assert rows(streams.drain_arrivals(spark, frames, build("leftOuter"), "append")) == [(1, 1), (2, None), (3, None), (4, 4)]
    assert rows(streams.drain_arrivals(spark, frames, build("fullOuter"), "append")) == [
        (1, 1), (2, None), (3, None), (4, 4), (None, 3), (None, 8), (None, 9)]


def test_state_that_ends_is_gone(spark):
    """An update function that returns None deletes the key, for later reads too."""
    def until_two(old, batch):
        return None if (batch["t"] == 2).any() else (old or 0) + len(batch)

    arrivals = [spark.createDataFrame(x, "k long, t long") for x in ([(1, 0), (2, 0)], [(1, 1)], [(2, 2)])]
    res = streams.drain_arrivals(spark, arrivals, lambda src: state.running_state(src, "k", "count", update=until_two),
                                 "update", ["k"])
    assert rows(state.last_state(res, "k", "count")) == [(1, 2)]


def test_update_mode_reads_the_last_batch_of_each_key(spark):
    out = scratch_path(spark, "updates")
    for batch, some in enumerate([[(1, "a", 1), (2, "b", 1)], [(1, "c", None)]]):
        spark.createDataFrame(some, "k long, v string, w long").write.parquet(f"{out}/batch_id={batch}")
    assert rows(streams.read_result(spark, out, "update", ["k"]), "k", "v", "w") == [(1, "c", None), (2, "b", 1)]


def test_kafka_shape(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    back = streams.decode_kafka(streams.encode_kafka(df, "k", "v"))
    assert rows(back) == [("1", "a"), ("2", "b")]


def test_rate_source_runs(spark):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 5).load()
    q, out = streams.run_stream(rate.select("value"), mode="append", trigger={"processingTime": "1 second"})
    time.sleep(4)
    q.stop()
    assert spark.read.parquet(out).count() >= 5


def test_text_snapshots_per_batch(spark):
    data = spark.range(0, 30).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    d = streams.split_to_files(data, "t", 3)
    src = streams.file_stream(spark, d, "parquet", spark.read.parquet(d).schema, max_files_per_trigger=1)
    counts = state.running_count(src.select("k"), "k")
    out = scratch_path(spark, "snapshots")
    fb = streams.per_batch(lambda b: b.select(F.format_string("(%d, %d)", "k", "count").alias("value")), out,
                           fmt="text")
    q, _ = streams.run_stream(counts, out, "complete", foreach_batch=fb)
    q.awaitTermination()
    snaps = spark.read.text(out)
    last = snaps.agg(F.max("batch_id")).first()[0]
    assert sorted(r["value"] for r in snaps.filter(F.col("batch_id") == last).collect()) == \
        ["(0, 10)", "(1, 10)", "(2, 10)"]
    assert snaps.select("batch_id").distinct().count() == 3


def test_console_and_memory_sinks(spark):
    ev = streams.table_stream(spark, SF_SMALL, "events", event_time="ts")
    q, _ = streams.run_stream(ev.groupBy("event_type").count(), mode="complete", sink="memory",
                              query_name="tw_event_counts")
    q.awaitTermination()
    assert spark.table("tw_event_counts").count() == 5
    q2, _ = streams.run_stream(ev.select("event_id"), mode="append", sink="console", numRows=2,
                               truncate="false")
    q2.awaitTermination()


def test_observed_batches_and_models_beside_them(spark):
    """One dict for each micro-batch, and a model with a training summary can still be fitted in the caller's session."""
    from pyspark.ml.feature import VectorAssembler

    from tablework.ml import models

    data = spark.range(60).select("id", (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 5).cast("double").alias("x"))
    d = streams.in_order_files(data, "id", 3)
    build = lambda side: streams.file_stream(side, d, "parquet", data.schema, max_files_per_trigger=1).filter("id >= 0").select("id", "x")
    out, batches = streams.drain_observed(build, spark, {"n": F.count(F.lit(1)), "most": F.max("id")})
    assert out.count() == 60 and len(batches) == 3 and sum(b["n"] for b in batches) == 60
    assert [b["batch"] for b in batches] == [0, 1, 2] and [b["most"] for b in batches] == sorted(b["most"] for b in batches) and batches[-1]["most"] == 59
    model, _ = models.fit_predict([VectorAssembler(inputCols=["x"], outputCol="features"), models.estimator("logistic", maxIter=2)], data)
    assert model.stages[-1].summary.accuracy >= 0
