"""Sliding windows kept up incrementally: what enters is added, what leaves is subtracted.

A window is made of panes one slide long.  The state of a key is the count and sum of each of its
panes, and those of the window emitted last: one value, read and written once for a key in a batch,
since every exchange with the store costs more than the sums do.  When the watermark passes the end of
the next window, an event-time timer adds the pane that enters and takes away the one that
leaves, whatever the window's length.  A window whose count has just fallen to zero is emitted
with a zero, then the key rests, without state, until rows come again.
"""

from __future__ import annotations

from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class PaneWindow(StatefulProcessor):
    """Windows of ``length`` ms every ``slide`` ms over rows with the columns ``at_ms`` and ``amount``."""

    def __init__(self, key: str, length: int, slide: int):
        self.key, self.length, self.slide = key, length, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # panes: start, n and total of one after another
        self.kept = handle.getValueState("kept", "n long, total long, end long, panes binary")

    def _read(self) -> tuple[int, int, int | None, dict[int, tuple[int, int]]]:
        if not self.kept.exists():
            return 0, 0, None, {}
        n, total, end, packed = self.kept.get()
        flat = array("q", bytes(packed))
        return n, total, end, {at: (m, t) for at, m, t in zip(flat[::3], flat[1::3], flat[2::3])}

    def _write(self, n: int, total: int, end: int, panes: dict[int, tuple[int, int]]) -> None:
        flat = array("q", [x for at, (m, t) in panes.items() for x in (at, m, t)])
        self.kept.update((n, total, end, flat.tobytes()))

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs()
        new: dict[int, tuple[int, int]] = {}
        for chunk in rows:
            at, amount = chunk["at_ms"].to_numpy(), chunk["amount"].to_numpy()
            timely = at >= mark  # what is behind the watermark comes too late
            starts, place = np.unique(at[timely] // self.slide * self.slide, return_inverse=True)
            sums = np.zeros(len(starts), np.int64)
            np.add.at(sums, place, amount[timely])
            for start, m, t in zip(starts.tolist(), np.bincount(place, minlength=len(starts)).tolist(), sums.tolist()):
                old = new.get(start, (0, 0))
                new[start] = (old[0] + m, old[1] + t)
        if new:
            n, total, end, panes = self._read()
            for start, (m, t) in new.items():
                old = panes.get(start, (0, 0))
                panes[start] = (old[0] + m, old[1] + t)
            first = min(new) + self.slide
            if end is None or first < end:  # a key that rests waits for its earliest pane
                if end is not None:
                    self.handle.deleteTimer(end)
                n, total, end = 0, 0, first
                self.handle.registerTimer(first)
            self._write(n, total, end, panes)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        mark = timerValues.getCurrentWatermarkInMs()
        n, total, end, panes = self._read()
        out = []
        while end is not None and end <= mark:
            entering, leaving = panes.get(end - self.slide, (0, 0)), panes.pop(end - self.slide - self.length, (0, 0))
            n, total = n + entering[0] - leaving[0], total + entering[1] - leaving[1]
            out.append((key[0], end - self.length, n, total))
            if n:
                end += self.slide
            else:
                end = min(panes) + self.slide if panes else None
        if end is None:
            self.kept.clear()
        else:
            self._write(n, total, end, panes)
            self.handle.registerTimer(end)
        yield pd.DataFrame(out, columns=[self.key, "start", "n", "total"])

    def close(self) -> None:
        pass


def inverse_window(df: DataFrame, key: str, ts: str, value: Column, length: int, slide: int, watermark: str) -> DataFrame:
    """Rows (``key``, window_start, n, total): count of rows and sum of the integer ``value`` for each window of
    ``length`` seconds every ``slide`` seconds that the watermark has passed.

    ``length`` is a multiple of ``slide``.  A row behind the watermark
    is dropped.  Null keys are a key; rows without a time are dropped, a null value counts as 0.  The stream's
    session has to keep its state in RocksDB (``state.state_session``); run it in append mode.
    """
    if length % slide:
        raise ValueError("the length has to be a multiple of the slide")
    kind = df.schema[key].dataType.simpleString()
    rows = (df.filter(F.col(ts).isNotNull()).withWatermark(ts, watermark)
            .select(key, ts, F.unix_millis(ts).alias("at_ms"), F.coalesce(value.cast("long"), F.lit(0)).alias("amount")))
    panes = rows.groupBy(key).transformWithStateInPandas(
        PaneWindow(key, 1000 * length, 1000 * slide), f"{key} {kind}, start long, n long, total long", "Append", "EventTime")
    return panes.select(key, F.timestamp_millis("start").alias("window_start"), "n", "total")
