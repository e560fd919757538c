"""Structured Streaming operators.

Sources are file streams (any directory + glob, rate-limited with
``maxFilesPerTrigger``); sinks are replay-safe:

* ``append``  – the parquet file sink (exactly-once through its commit log);
* ``update`` / ``complete`` – ``foreachBatch`` writing each micro-batch to
  ``<out>/batch_id=<n>`` with overwrite, so a re-run batch replaces its own
  output.  ``read_result`` turns the folders back into the current table
  (latest row per key for update mode, the last batch for complete mode).

Queries default to ``trigger(availableNow=True)``: process everything that
is there, in as many micro-batches as the rate limit asks for, then stop.
Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import is_folder, scratch_path, side_session
from ..tables import path as table_path


def file_stream(spark: SparkSession, directory: str, fmt: str = "parquet", schema=None,
                glob: str | None = None, max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Stream the files of ``directory`` (a folder, never a single file)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(directory)


def table_stream(spark: SparkSession, sf_dir: str, table: str, max_files_per_trigger: int | None = None,
                 event_time: str | None = None) -> DataFrame:
    """A driver table as a stream: its folder of files or, of a table in one
    file, the folder around it + ``<table>.parquet`` glob.

    ``event_time`` names a TIMESTAMP_NTZ column to convert to TIMESTAMP, which
    watermarks require.
    """
    where = table_path(sf_dir, table)
    schema = spark.read.parquet(where).schema
    if is_folder(spark, where):
        df = file_stream(spark, where, "parquet", schema, max_files_per_trigger=max_files_per_trigger)
    else:
        df = file_stream(spark, sf_dir, "parquet", schema, glob=f"{table}.parquet",
                         max_files_per_trigger=max_files_per_trigger)
    if event_time:
        df = df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def split_to_files(df: DataFrame, order_col: str, n: int, out: str | None = None,
                   fmt: str = "parquet") -> str:
    """Write ``df`` as ``n`` range-partitioned files in ``fmt`` (a replayable
    sequence of input files for multi-batch stream tests and backfills)."""
    out = out or scratch_path(df.sparkSession, "stream-input")
    df.repartitionByRange(n, order_col).sortWithinPartitions(order_col).write.format(fmt).save(out)
    return out


def in_order_files(df: DataFrame, order_col: str, n: int, fmt: str = "parquet") -> str:
    """``split_to_files``, but each range is written by a job of its own, one after another: a file
    stream, which goes by modification time, then meets them in this order."""
    from ..functions.common import literal_cuts

    out = scratch_path(df.sparkSession, "stream-input")
    cuts = [c[0] for c in literal_cuts(df, [order_col], n)]
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = df if low is None else df.filter(F.col(order_col) >= F.lit(low))
        part = part if high is None else part.filter(F.col(order_col) < F.lit(high))
        part.coalesce(1).write.format(fmt).mode("append").save(out)
    return out


def _batch_writer(out: str, fmt: str = "parquet"):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{out}/batch_id={batch_id}")
    return write


def run_stream(df: DataFrame, out: str | None = None, mode: str = "append",
               checkpoint: str | None = None, trigger: dict | None = None,
               foreach_batch: Callable[[DataFrame, int], None] | None = None,
               query_name: str | None = None, sink: str | None = None,
               **sink_options) -> tuple[StreamingQuery, str]:
    """Start ``df`` as a streaming query; returns ``(query, out_path)``.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (default
    ``{"availableNow": True}``; e.g. ``{"processingTime": "8 seconds"}``).
    ``sink`` names a built-in sink instead of the replay-safe default, e.g.
    ``"console"`` (with ``truncate``/``numRows``) or ``"memory"`` (needs
    ``query_name``) for interactive inspection.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, "stream-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-ckpt")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    if query_name:
        w = w.queryName(query_name)
    if sink is not None:
        w = w.format(sink)
        for k, v in sink_options.items():
            w = w.option(k, v)
    elif foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    elif mode == "append":
        w = w.format("parquet").option("path", out)
    else:
        w = w.foreachBatch(_batch_writer(out))
    return w.start(), out


def read_result(spark: SparkSession, out: str, mode: str = "append", keys: list[str] | None = None,
                schema=None) -> DataFrame:
    """The table a sink folder represents (see module doc)."""
    r = spark.read
    if schema is not None and mode == "append":
        r = r.schema(schema)
    df = r.parquet(out)
    if mode == "append":
        return df
    if mode == "complete":
        last = df.agg(F.max("batch_id").alias("batch_id"))
        return df.join(F.broadcast(last), "batch_id").drop("batch_id")
    if not keys:
        raise ValueError("update mode needs the key columns")
    values = [c for c in df.columns if c not in (*keys, "batch_id")]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(F.lit(1).alias("_one"), *values), "batch_id").alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values])


def drain(df: DataFrame, mode: str = "append", keys: list[str] | None = None,
          out: str | None = None, checkpoint: str | None = None,
          batch_fn: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run ``df`` to the end of its available input and return the sink's table.

    With ``batch_fn`` every micro-batch is transformed by it and stored with
    its ``batch_id`` (``foreachBatch``); the result holds all batches.
    """
    spark = df.sparkSession
    out = out or scratch_path(spark, "stream-out")
    fb = per_batch(batch_fn, out) if batch_fn is not None else None
    q, out = run_stream(df, out, mode, checkpoint, foreach_batch=fb)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if fb is not None:
        return spark.read.parquet(out)
    return read_result(spark, out, mode, keys, schema=df.schema if mode == "append" else None)


def drain_arrivals(spark: SparkSession, arrivals: list[DataFrame], build: Callable[[DataFrame], DataFrame],
                   mode: str = "update", keys: list[str] | None = None) -> DataFrame:
    """Feed ``arrivals`` to a stream one after another and return the sink's table.

    Each arrival is written to the source folder and the query is run to the
    end of its input on one checkpoint, so state and watermark carry over as
    they would between restarts.  ``build`` turns the source stream into the
    streaming query's DataFrame.
    """
    src, out, ckpt = (scratch_path(spark, f"arrivals-{x}") for x in ("in", "out", "ckpt"))
    for part in arrivals:
        part.write.mode("append").parquet(src)
        result = drain(build(file_stream(spark, src, "parquet", part.schema)), mode, keys, out, ckpt)
    return result


def window_start(w: str = "window", fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Window start as text (engine-neutral; session zone)."""
    return F.date_format(F.col(f"{w}.start"), fmt)


def sliding_agg(df: DataFrame, ts: str, keys: list[str], agg: Column, length: str, slide: str | None = None,
                watermark: str | None = None) -> DataFrame:
    """Event-time window aggregate (tumbling when ``slide`` is None)."""
    if watermark:
        df = df.withWatermark(ts, watermark)
    win = F.window(ts, length, slide) if slide else F.window(ts, length)
    return df.groupBy(win.alias("window"), *keys).agg(agg)


def per_batch(fn: Callable[[DataFrame], DataFrame], out: str, fmt: str = "parquet",
              **options) -> Callable[[DataFrame, int], None]:
    """``transform(func)`` / per-batch reduce / per-batch snapshots: apply
    ``fn`` to each micro-batch and store its result tagged with the batch id
    (replay-safe overwrite).  ``fmt="text"`` writes one text snapshot folder
    per batch, like saving each batch's state as text files."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # The folder name carries the batch id (read back as a partition column).
        w = fn(batch).write.mode("overwrite").format(fmt)
        for k, v in options.items():
            w = w.option(k, v)
        w.save(f"{out}/batch_id={batch_id}")
    return write


def encode_kafka(df: DataFrame, key: Column | str, value: Column | str) -> DataFrame:
    """Rows in the Kafka wire shape: ``key``/``value`` as UTF-8 binary."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.select(F.encode(k.cast("string"), "UTF-8").alias("key"),
                     F.encode(v.cast("string"), "UTF-8").alias("value"))


def decode_kafka(df: DataFrame) -> DataFrame:
    """``CAST(key AS STRING), CAST(value AS STRING)`` of Kafka-shaped rows."""
    return df.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")


def stream_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, within: str,
                watermark: str, how: str = "inner") -> DataFrame:
    """Time-bounded stream-stream join: ``right.rts`` within ``within`` after
    ``left.lts`` on the same key.  Watermarks on both sides bound the state.

    With ``how`` ``leftOuter`` or ``fullOuter`` a row without a partner comes out with nulls once the
    watermark (the lesser of both sides') has passed the last time at which one could come: ``within``
    after a left row, the row's own time for a right one.  Rows that still wait are in the state.
    """
    lw = left.withWatermark(lts, watermark).alias("l")
    rw = right.withWatermark(rts, watermark).alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"r.{rts}") >= F.col(f"l.{lts}"))
            & (F.col(f"r.{rts}") <= F.col(f"l.{lts}") + F.expr(f"INTERVAL {within}")))
    return lw.join(rw, cond, how)


def drain_observed(build: Callable[[SparkSession], DataFrame], spark: SparkSession, metrics: dict[str, Column], mode: str = "append",
                   keys: list[str] | None = None) -> tuple[DataFrame, list[dict]]:
    """Run a stream to the end of its input while counting beside it, as accumulators would.

    ``build`` makes the stream in the session that it is given; ``metrics`` are aggregates over the rows of each
    micro-batch.  Returns the sink's table and a dict for each batch with rows: ``batch`` and the metrics, as the query's progress
    reports them (a batch that is run again reports again under the same number, so the last one counts).

    A session that has observed something cannot serialise the training summaries of models any more, so the
    stream gets a session of its own.
    """
    side = side_session(spark, {"spark.sql.streaming.numRecentProgressUpdates": "100000"})
    seen = build(side).observe("tablework", *[m.alias(n) for n, m in metrics.items()])
    query, out = run_stream(seen, None, mode)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    batches = {}
    for p in query.recentProgress:
        got = (p["observedMetrics"] if isinstance(p, dict) else p.observedMetrics).get("tablework")
        if got is not None:
            got = got.asDict() if hasattr(got, "asDict") else dict(got)
            batches[p["batchId"] if isinstance(p, dict) else p.batchId] = got
    return read_result(side, out, mode, keys, schema=seen.schema if mode == "append" else None), [
        {"batch": b, **m} for b, m in sorted(batches.items())]
