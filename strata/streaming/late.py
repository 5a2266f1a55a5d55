"""Counts per window of event time, with a second output for events behind the watermark.

Spark's own windowed count drops such events. Here keyed state counts the events of open windows and
gives a window out once the watermark has passed it; events that come later still are given out at
once as corrections. Windows plus corrections are what a batch job counts over the same events.

A window is dealt to ``salts`` keys, so a day that holds most events is no single task; their shares
are added up by ``corrected_throughput``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from strata.functions import utc_date
from strata.streaming.flows import run_available, to_parquet

SALTS = 16
FINAL, CORRECTION = "final", "correction"

_OUT = "start bigint, end bigint, kind string, event_count bigint"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Windows(StatefulProcessor):
    """State of a key (a share of a window): events so far; none before the first and after the end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("count", "event_count bigint")

    def _row(self, key: tuple, kind: str, count: int) -> pd.DataFrame:
        return pd.DataFrame(
            {"start": [key[0]], "end": [key[1]], "kind": [kind], "event_count": [count]}
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = sum(int(batch["event_count"].sum()) for batch in rows)
        end = -(-key[1] // 1000)
        if end <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, CORRECTION, new)
            return
        if not self._count.exists():
            self._handle.registerTimer(end)
            self._count.update((new,))
        else:
            self._count.update((self._count.get()[0] + new,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count = self._count.get()[0]
        self._count.clear()
        yield self._row(key, FINAL, count)

    def close(self) -> None:
        pass


def throughput_with_corrections(
    events: DataFrame,
    time: str = "ts",
    late_by: str = "1 day",
    every: str = "1 day",
    salts: int = SALTS,
) -> DataFrame:
    """Rows of ``window_start``, ``window_end``, ``event_date``, ``kind`` and ``event_count``.

    ``kind`` is "final" once per share of a window, when the watermark (the latest event time less
    ``late_by``) has passed the window's end, and "correction" per batch for events that come after. Events
    without a time belong to no window. Needs the RocksDB state store (``with_rocksdb``).
    """
    # Plain numbers carry no watermark of their own, so that late rows reach the state.
    seen = events.withWatermark(time, late_by).where(F.col(time).isNotNull())
    window = F.window(time, every)
    keyed = seen.select(
        F.unix_micros(window["start"]).alias("start"),
        F.unix_micros(window["end"]).alias("end"),
        F.pmod(F.xxhash64(*[c for c in events.columns]), F.lit(salts)).alias("salt"),
        F.lit(1).cast("bigint").alias("event_count"),
    )
    rows = keyed.groupBy("start", "end", "salt").transformWithStateInPandas(
        _Windows(), _OUT, "Append", "EventTime"
    )
    start = F.timestamp_micros("start")
    return rows.select(
        start.alias("window_start"),
        F.timestamp_micros("end").alias("window_end"),
        utc_date(start).alias("event_date"),
        "kind",
        "event_count",
    )


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state with timers asks for."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_throughput(
    events: DataFrame, path: str, checkpoint: str, **options
) -> StreamingQuery:
    """What the stream holds now to a folder per ``kind``, exactly once; the next run goes on."""
    with with_rocksdb(events.sparkSession):
        rows = throughput_with_corrections(events, **options)
        return run_available(to_parquet(rows, path, checkpoint, ["kind"]))


def corrected_throughput(rows: DataFrame) -> DataFrame:
    """In batch: the counts of closed windows, corrections included, and how many came late."""
    late = F.when(F.col("kind") == CORRECTION, F.col("event_count"))
    return rows.groupBy("window_start", "window_end", "event_date").agg(
        F.sum("event_count").alias("event_count"),
        F.coalesce(F.sum(late), F.lit(0)).alias("late_count"),
    )
