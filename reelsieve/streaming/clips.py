"""Structured Streaming forms of the windowed kernels: tumbling chunks with late data, and a running average with state."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues


def tumbling(events: DataFrame, key: str, time: str, value: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Count and mean per key and window; events later than `late` are dropped, as the watermark has it. time: timestamp."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).select(key, F.col("window.start").alias("start"), "n", "mean")


class _Ema(StatefulProcessor):
    """Rows wait in state until the watermark has passed them; then they are folded in the order of their times."""

    def __init__(self, key: str, momentum: float):
        self.key, self.momentum = key, momentum

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ms long, value double")
        self.last = handle.getValueState("last", "n long, ema double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            for ms, value in zip(batch["ms"], batch["value"], strict=True):
                self.waiting.appendValue((int(ms), None if pd.isna(value) else float(value)))
                self.handle.registerTimer(int(ms))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = expiredTimerInfo.getExpiryTimeInMs()
        rows = [(ms, value) for ms, value in self.waiting.get()]
        ready = sorted((r for r in rows if r[0] <= passed), key=lambda r: (r[0], r[1] is not None, r[1] or 0.0))
        if not ready:
            return
        n, last = self.last.get() if self.last.exists() else (0, None)
        out = []
        for ms, x in ready:
            n += 1
            if x is not None and math.isfinite(x):
                last = x if last is None else self.momentum * last + (1 - self.momentum) * x
            out.append((key[0], pd.Timestamp(ms, unit="ms"), n, last))
        self.last.update((n, last))
        self.waiting.put([r for r in rows if r[0] > passed])
        yield pd.DataFrame(out, columns=[self.key, "time", "n", "ema"])

    def close(self) -> None:
        pass


def running_ema(events: DataFrame, key: str, time: str, value: str, momentum: float = 0.99, late: str = "10 minutes") -> DataFrame:
    """key, time, n, ema: an exponential moving average that goes on over micro-batches, a row for each event.

    Events are folded by time, not by arrival: each waits until the watermark (the latest time less `late`) has passed it, which
    its timer tells; events behind the watermark of the batch before are dropped. So the rows are those of a fold over all events that were not
    dropped. Null, NaN and infinite values repeat the average. State of a key: what waits, the count and the average. The session
    needs the RocksDB state store (use_state_store).
    """
    kind = dict(events.dtypes)[key]
    rows = events.withWatermark(time, late).select(key, time, F.unix_millis(F.col(time).cast("timestamp")).alias("ms"), F.col(value).cast("double").alias("value"))
    return rows.groupBy(key).transformWithStateInPandas(_Ema(key, momentum), f"`{key}` {kind}, time timestamp, n long, ema double", "Append", "EventTime")


def use_state_store(spark: SparkSession) -> None:
    """Stateful processors keep several states in one store, which only this one does."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
