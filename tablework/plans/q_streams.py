"""Streaming queries (R01-R24): each runs a Structured Streaming query over
files derived from the tables to completion (``availableNow``) and returns
the sink's table.  Oracles are the equivalent batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import r
from ..operators import text
from ..session import scratch_path
from ..streaming import panes, state, streams
from ..tables import load
from .registry import query


def _events_stream(spark, sf, files: int | None = None):
    """``events`` as a stream; with ``files`` it is first laid out as that
    many time-ordered files and read one file per micro-batch."""
    if files:
        d = streams.split_to_files(load(spark, sf, "events"), "ts", files)
        schema = spark.read.parquet(d).schema
        df = streams.file_stream(spark, d, "parquet", schema, max_files_per_trigger=1)
        return df.withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.table_stream(spark, sf, "events", event_time="ts")


_WORDS_SQL = """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word"""


@query("stream_word_count", _WORDS_SQL)
def stream_word_count(spark, sf):
    docs = streams.table_stream(spark, sf, "documents")
    counts = text.word_count(docs, "text")
    return streams.drain(counts, "update", keys=["word"])  # a batch writes the words it changed


def _files_per_batch(df, batches: int) -> int:
    """Files for each of ``batches``, at least one and together no fewer than the tasks that read ``df``: no task
    writes more than one of those reads."""
    return max(1, -(-df.rdd.getNumPartitions() // batches))


@query("stream_word_count_batch", """
SELECT word, count(*) AS n
FROM (SELECT unnest(string_split(line, ' ')) AS word
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
GROUP BY word""")
def stream_word_count_batch(spark, sf):
    """New text files arrive in four micro-batches; each batch is counted on
    its own (``foreachBatch``) and the per-batch counts are summed.

    A batch is one file of a small table, and more files the larger the table is."""
    d = scratch_path(spark, "text-arrivals")
    docs = load(spark, sf, "documents").select("doc_id", "text")
    each = _files_per_batch(docs, 4)
    docs.repartitionByRange(4 * each, "doc_id").select("text").write.option("lineSep", "\n").text(d)
    lines = streams.file_stream(spark, d, "text", max_files_per_trigger=each, lineSep="\n")
    per = streams.drain(lines, "append",
                        batch_fn=lambda b: text.word_count(b, "value"))
    return per.groupBy("word").agg(F.sum("n").alias("n"))


@query("stream_mod_count", """
SELECT CAST(((o_orderkey % 10) + 10) % 10 AS INTEGER) AS m, count(*) AS count FROM orders GROUP BY 1""")
def stream_mod_count(spark, sf):
    d = streams.split_to_files(load(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)
    s = streams.file_stream(spark, d, "parquet", spark.read.parquet(d).schema, max_files_per_trigger=1)
    counts = s.groupBy(F.pmod("o_orderkey", F.lit(10)).cast("int").alias("m")).count()
    return streams.drain(counts, "update", keys=["m"])


@query("stream_stateless", """
SELECT event_id, round(value * 2, 4) AS v2, upper(event_type) AS kind FROM events
WHERE event_type = 'click'""")
def stream_stateless(spark, sf):
    ev = _events_stream(spark, sf)
    out = ev.filter(F.col("event_type") == "click") \
            .select("event_id", r(F.col("value") * 2).alias("v2"), F.upper("event_type").alias("kind"))
    return streams.drain(out, "append")


@query("stream_batch_aggs", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type""")
def stream_batch_aggs(spark, sf):
    ev = _events_stream(spark, sf, files=4)
    per = streams.drain(ev, "append", batch_fn=lambda b: b.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))
    return per.groupBy("event_type").agg(F.sum("n").alias("n"), r(F.sum("total")).alias("total"))


@query("stream_union", """
SELECT event_type, count(*) AS count FROM events WHERE event_type IN ('view', 'click') GROUP BY event_type""")
def stream_union(spark, sf):
    ev = _events_stream(spark, sf)
    views = ev.filter(F.col("event_type") == "view")
    clicks = ev.filter(F.col("event_type") == "click")
    return streams.drain(views.unionByName(clicks).groupBy("event_type").count(), "complete")


@query("stream_join", """
SELECT s.event_id AS signup_id, p.event_id AS purchase_id
FROM events s JOIN events p
  ON s.user_id = p.user_id AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 1 HOUR
WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""")
def stream_join(spark, sf):
    ev = _events_stream(spark, sf)
    signups = ev.filter(F.col("event_type") == "signup").select("event_id", "user_id", "ts")
    buys = ev.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    j = streams.stream_join(signups, buys, "user_id", "ts", "ts", "1 HOUR", "2 hours")
    return streams.drain(j.select(F.col("l.event_id").alias("signup_id"),
                                  F.col("r.event_id").alias("purchase_id")), "append")


@query("stream_transform", """
SELECT event_id, user_id, round(value, 2) AS value FROM events WHERE value > 90""")
def stream_transform(spark, sf):
    ev = _events_stream(spark, sf, files=3)

    def fn(b):
        return b.transform(lambda d: d.filter(F.col("value") > 90)
                           .select("event_id", "user_id", r("value", 2).alias("value")))

    return streams.drain(ev, "append", batch_fn=fn).drop("batch_id")


@query("stream_sliding_sum", """
SELECT strftime(time_bucket(INTERVAL 10 SECOND, ts) - k * INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type, round(sum(value), 4) AS total
FROM events, range(3) t(k) GROUP BY 1, 2""")
def stream_sliding_sum(spark, sf):
    ev = _events_stream(spark, sf)
    agg = streams.sliding_agg(ev, "ts", ["event_type"], F.sum("value").alias("total"),
                              "30 seconds", "10 seconds", watermark="1 minute")
    res = streams.drain(agg.select(streams.window_start().alias("window_start"), "event_type", "total"),
                        "update", keys=["window_start", "event_type"])
    return res.withColumn("total", r("total"))


_HOURLY = "strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S')"


@query("stream_count_by_window", f"SELECT {_HOURLY} AS window_start, count(*) AS count FROM events GROUP BY 1")
def stream_count_by_window(spark, sf):
    ev = _events_stream(spark, sf)
    agg = streams.sliding_agg(ev, "ts", [], F.count(F.lit(1)).alias("count"), "1 hour", watermark="1 hour")
    return streams.drain(agg.select(streams.window_start().alias("window_start"), "count"), "update", keys=["window_start"])


@query("stream_value_count_by_window", f"""
SELECT {_HOURLY} AS window_start, event_type, count(*) AS count FROM events GROUP BY 1, 2""")
def stream_value_count_by_window(spark, sf):
    ev = _events_stream(spark, sf)
    agg = streams.sliding_agg(ev, "ts", ["event_type"], F.count(F.lit(1)).alias("count"), "1 hour", watermark="1 hour")
    return streams.drain(agg.select(streams.window_start().alias("window_start"), "event_type", "count"),
                         "update", keys=["window_start", "event_type"])


@query("stream_watermark_count", f"""
SELECT {_HOURLY} AS window_start, event_type, count(*) AS count FROM events GROUP BY 1, 2""")
def stream_watermark_count(spark, sf):
    ev = _events_stream(spark, sf)
    agg = streams.sliding_agg(ev, "ts", ["event_type"], F.count(F.lit(1)).alias("count"), "1 hour",
                              watermark="1 hour")
    return streams.drain(agg.select(streams.window_start().alias("window_start"), "event_type", "count"),
                         "update", keys=["window_start", "event_type"])


@query("stream_tumbling_purchases", """
SELECT user_id AS district, strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS count
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""")
def stream_tumbling_purchases(spark, sf):
    """Purchases per district per 1-minute window over a JSON file source
    with an explicit schema, read at most 2 files per micro-batch.  The
    watermark bounds the state; only the result is sorted."""
    ev = load(spark, sf, "events").select("ts", F.col("event_type").alias("action"),
                                          F.col("user_id").alias("district"))
    d = streams.in_order_files(ev, "ts", 6, fmt="json")
    schema = "ts timestamp_ntz, action string, district long"
    src = streams.file_stream(spark, d, "json", schema, max_files_per_trigger=2) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    buys = src.filter(F.col("action") == "purchase")
    agg = streams.sliding_agg(buys, "ts", ["district"], F.count(F.lit(1)).alias("count"), "1 minute", watermark="10 minutes")
    out = streams.drain(agg.select("district", streams.window_start().alias("window_start"), "count"), "update",
                        keys=["window_start", "district"])
    return out.orderBy("window_start", "district")


@query("stream_running_count", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_running_count(spark, sf):
    ev = _events_stream(spark, sf, files=4).select("user_id")
    return streams.drain(state.running_count(ev, "user_id"), "update", keys=["user_id"])


@query("stream_seeded_state", "SELECT user_id, count(*) AS count FROM events GROUP BY user_id")
def stream_seeded_state(spark, sf):
    """State seeded from a table (signup counts), then fed by the stream; the
    last state of every key, of seeded keys without new rows too."""
    spark = state.state_session(spark)
    seed = load(spark, sf, "events").filter(F.col("event_type") == "signup") \
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("count"))
    ev = _events_stream(spark, sf, files=3).filter(F.col("event_type") != "signup").select("user_id")
    run = state.running_state(ev, "user_id", "count", initial=seed)
    return state.last_state(streams.drain(run, "update", keys=["user_id"]), "user_id", "count", seed)


_ARRIVAL = "CAST(least(3, floor(4 * (epoch(ts) - lo) / (hi - lo + 1)) + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END) AS INTEGER)"


@query("stream_late_drop", f"""
WITH b AS (SELECT min(epoch(ts)) AS lo, max(epoch(ts)) AS hi FROM events),
a AS (SELECT ts, event_type, {_ARRIVAL} AS arrival FROM events, b),
seen AS (SELECT k AS arrival, (SELECT max(ts) FROM a WHERE a.arrival < k) - INTERVAL 1 HOUR AS mark FROM range(4) t(k))
SELECT {_HOURLY} AS window_start, event_type, count(*) AS count
FROM a JOIN seen USING (arrival)
WHERE mark IS NULL OR time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR > mark GROUP BY 1, 2""")
def stream_late_drop(spark, sf):
    """Hourly counts with a one-hour watermark over four arrivals.  Every
    tenth event comes two arrivals late; those behind the watermark of the
    arrivals before are dropped."""
    ev = load(spark, sf, "events").select("ts", "event_type", "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    lo, hi = ev.agg(F.min(micros), F.max(micros)).first()
    late = F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    arrival = F.least(F.lit(3), F.floor(4 * (micros - F.lit(lo)) / F.lit(hi - lo + 1)) + late).cast("int")
    rows_ = ev.withColumn("arrival", arrival).withColumn("ts", F.col("ts").cast("timestamp"))
    arrivals = [rows_.filter(F.col("arrival") == k).select("ts", "event_type") for k in range(4)]

    def build(src):
        agg = streams.sliding_agg(src, "ts", ["event_type"], F.count(F.lit(1)).alias("count"), "1 hour", watermark="1 hour")
        return agg.select(streams.window_start().alias("window_start"), "event_type", "count")

    return streams.drain_arrivals(spark, arrivals, build, "update", ["window_start", "event_type"])


def _arrivals(spark, sf, late: bool):
    """Events in four arrivals by time; with ``late`` every tenth event comes two arrivals late."""
    ev = load(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    lo, hi = ev.agg(F.min(micros), F.max(micros)).first()
    behind = F.when(F.col("event_id") % 10 == 0, 2).otherwise(0) if late else F.lit(0)
    arrival = F.least(F.lit(3), F.floor(4 * (micros - F.lit(lo)) / F.lit(hi - lo + 1)) + behind).cast("int")
    rows_ = ev.withColumn("arrival", arrival).withColumn("ts", F.col("ts").cast("timestamp"))
    return [rows_.filter(F.col("arrival") == k).drop("arrival", "props") for k in range(4)]


_SIX_HOURS, _DAY = 6 * 3600, 24 * 3600


@query("stream_window_inverse", f"""
WITH b AS (SELECT min(epoch(ts)) AS lo, max(epoch(ts)) AS hi FROM events),
a AS (SELECT user_id, epoch_ms(ts) AS ms, CAST(round(value * 100) AS BIGINT) AS cents, {_ARRIVAL} AS arrival FROM events, b),
seen AS (SELECT k AS arrival, coalesce((SELECT max(ms) FROM a WHERE a.arrival < k) - 3600000, 0) AS mark FROM range(5) t(k)),
pane AS (
  SELECT user_id, ms // {_SIX_HOURS * 1000} * {_SIX_HOURS * 1000} AS p, count(*) AS n, sum(cents) AS total
  FROM a JOIN seen USING (arrival) WHERE ms >= mark GROUP BY 1, 2),
full_ AS (
  SELECT user_id, p - k * {_SIX_HOURS * 1000} AS start, sum(n) AS n, sum(total) AS total FROM pane, range(4) t(k) GROUP BY 1, 2),
zero AS (
  SELECT user_id, start + {_SIX_HOURS * 1000} AS start, 0 AS n, 0 AS total FROM full_ f
  WHERE NOT EXISTS (SELECT 1 FROM full_ g WHERE g.user_id = f.user_id AND g.start = f.start + {_SIX_HOURS * 1000}))
SELECT user_id, strftime(make_timestamp(start * 1000), '%Y-%m-%d %H:%M:%S') AS window_start, CAST(n AS BIGINT) AS n, CAST(total AS BIGINT) AS total
FROM (SELECT * FROM full_ UNION ALL SELECT * FROM zero) WHERE start + {_DAY * 1000} <= (SELECT mark FROM seen WHERE arrival = 4)""")
def stream_window_inverse(spark, sf):
    """Events and their value (cents) of each user in one-day windows every six hours, by adding the pane that
    enters and taking away the one that leaves; four arrivals, some events too late.  A user's window
    that has just become empty is a row with zeros."""
    spark = state.state_session(spark)

    def build(src):
        w = panes.inverse_window(src, "user_id", "ts", F.round(F.col("value") * 100), _DAY, _SIX_HOURS, "1 hour")
        return w.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))

    return streams.drain_arrivals(spark, _arrivals(spark, sf, late=True), build, "append")


_JOINED = """
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'),
p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
m AS (SELECT s.event_id AS signup_id, p.event_id AS purchase_id FROM s JOIN p
      ON s.user_id = p.user_id AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 1 HOUR),
mark AS (SELECT date_trunc('milliseconds', least((SELECT max(ts) FROM s), (SELECT max(ts) FROM p))) - INTERVAL 2 HOUR AS t)
SELECT signup_id, purchase_id FROM m
UNION ALL SELECT event_id, NULL FROM s, mark WHERE ts + INTERVAL 1 HOUR < t AND event_id NOT IN (SELECT signup_id FROM m)"""


def _outer_join(spark, sf, how):
    def build(src):
        signups, buys = (src.filter(F.col("event_type") == t).select("event_id", "user_id", "ts") for t in ("signup", "purchase"))
        j = streams.stream_join(signups, buys, "user_id", "ts", "ts", "1 HOUR", "2 hours", how)
        return j.select(F.col("l.event_id").alias("signup_id"), F.col("r.event_id").alias("purchase_id"))

    return streams.drain_arrivals(spark, _arrivals(spark, sf, late=False), build, "append")


@query("stream_left_join", _JOINED)
def stream_left_join(spark, sf):
    """Signups with the user's purchases of the next hour, in four arrivals; a signup without one comes out when the
    watermark has passed that hour."""
    return _outer_join(spark, sf, "leftOuter")


@query("stream_full_join", _JOINED + """
UNION ALL SELECT NULL, event_id FROM p, mark WHERE ts < t AND event_id NOT IN (SELECT purchase_id FROM m)""")
def stream_full_join(spark, sf):
    return _outer_join(spark, sf, "fullOuter")


@query("stream_observed", """
SELECT count(*) AS n, round(sum(value), 4) AS total, count_if(event_type = 'error') AS n_errors,
       round(sum(value) / count(*), 6) AS mean, count_if(value > 90) AS n_kept
FROM events""")
def stream_observed(spark, sf):
    """Side metrics of a filtered stream: sum, count and errors over all rows that came in, by micro-batch from the query's
    progress, then added up; beside them the rows that the stream kept."""
    d = streams.split_to_files(load(spark, sf, "events"), "ts", 5)

    def build(side):
        return streams.file_stream(side, d, "parquet", side.read.parquet(d).schema, max_files_per_trigger=1)

    metrics = {"n": F.count(F.lit(1)), "total": F.sum("value"), "n_errors": F.count_if(F.col("event_type") == "error"),
               "n_kept": F.count_if(F.col("value") > 90)}
    _, batches = streams.drain_observed(build, spark, metrics)
    rows_ = spark.createDataFrame([(b["batch"], b["n"], b["total"], b["n_errors"], b["n_kept"]) for b in batches],
                                  "batch long, n long, total double, n_errors long, n_kept long")
    return rows_.agg(F.sum("n").alias("n"), r(F.sum("total")).alias("total"), F.sum("n_errors").alias("n_errors"),
                     r(F.sum("total") / F.sum("n"), 6).alias("mean"), F.sum("n_kept").alias("n_kept"))


@query("stream_filter_parquet", """
SELECT word FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) WHERE length(word) = 5""")
def stream_filter_parquet(spark, sf):
    docs = streams.table_stream(spark, sf, "documents")
    w = text.words(docs, "text").filter(F.length("word") == 5)
    return streams.drain(w, "append")


@query("stream_kafka_shape", """
SELECT event_type AS key, event_type || ':' || CAST(count(*) AS VARCHAR) AS value
FROM events GROUP BY event_type""")
def stream_kafka_shape(spark, sf):
    ev = _events_stream(spark, sf)
    wire = streams.decode_kafka(streams.encode_kafka(ev, "user_id", "event_type"))
    counts = wire.groupBy("value").count()
    out = counts.select(F.col("value").alias("key"),
                        F.concat(F.col("value"), F.lit(":"), F.col("count").cast("string")).alias("value"))
    return streams.drain(out, "complete")
