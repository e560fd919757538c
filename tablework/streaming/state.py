"""Keyed running state across micro-batches (R11, ``updateStateByKey``).

Plain running aggregates (``running_count``) are Spark's own streaming
aggregation: JVM-side, two-phase, state in the state store.  Custom or
seeded state (``running_state``) is built on ``transformWithStateInPandas``
with a value state per key (RocksDB state store, checkpointed with the
query).  ``update(old, rows_pdf)`` is folded over the key's rows one Arrow
batch at a time (so a hot key never has all its rows in memory at once) and
returns the new value or ``None`` to delete the key; the processor emits the
new value of every key that received rows in the micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _count_update(old: int | None, batch: pd.DataFrame) -> int:
    return (old or 0) + len(batch)


class RunningValue(StatefulProcessor):
    """One value per key, folded over the key's rows batch by batch."""

    def __init__(self, key: str, out: str, update: Callable = _count_update,
                 state_type: str = "long"):
        self.key_name, self.out, self.update, self.state_type = key, out, update, state_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("value", f"value {self.state_type}")

    def handleInputRows(self, key, rows, timerValues):
        new = self.state.get()[0] if self.state.exists() else None
        for chunk in rows:
            new = self.update(new, chunk)
        if new is None:  # the null row tells the sink's reader that the key is gone
            self.state.clear()
        else:
            self.state.update((new,))
        yield pd.DataFrame({self.key_name: [key[0]], self.out: pd.array([new], dtype=object)})

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((initialState[self.out].iloc[0].item(),))

    def close(self) -> None:
        pass


def running_count(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    """Running count per key across micro-batches (built-in streaming
    aggregation; run it in ``update`` or ``complete`` mode)."""
    from pyspark.sql import functions as F

    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in
    RocksDB; the settings of ``spark`` itself are not touched."""
    side = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        if (value := spark.conf.get(key, None)) is not None:
            side.conf.set(key, value)
    side.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return side


def running_state(df: DataFrame, key: str, out: str = "count", key_type: str = "long",
                  update: Callable = _count_update, state_type: str = "long",
                  initial: DataFrame | None = None) -> DataFrame:
    """Running per-key state; ``initial`` (columns ``key``, ``out``) seeds it.

    The state store provider of the stream's session must be RocksDB (the
    session defaults set it; ``state_session`` gives a session that has it).  ``last_state`` turns the emitted updates into
    the table of all keys.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        raise ValueError(f"keyed state needs spark.sql.streaming.stateStore.providerClass={ROCKSDB}")
    schema = f"{key} {key_type}, {out} {state_type}"
    init = initial.groupBy(key) if initial is not None else None
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=RunningValue(key, out, update, state_type), outputStructType=schema,
        outputMode="Update", timeMode="None", initialState=init)


def last_state(updates: DataFrame, key: str, out: str = "count", initial: DataFrame | None = None) -> DataFrame:
    """The state of every key after a stream has ended.

    ``updates`` holds each updated key's last emitted value (null: deleted);
    seeded keys of ``initial`` that got no row keep their seed.
    """
    from pyspark.sql import functions as F

    if initial is not None:
        seed = initial.select(key, F.col(out).alias("_seed"))
        seen = updates.select(key, out, F.lit(True).alias("_seen"))
        updates = seed.join(seen, key, "full").select(
            key, F.when(F.col("_seen"), F.col(out)).otherwise(F.col("_seed")).alias(out))
    return updates.filter(F.col(out).isNotNull())
