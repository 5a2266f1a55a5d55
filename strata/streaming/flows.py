"""Topics as streams. The transforms are those of the batch jobs; only source and sink differ."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from strata.contracts import Column, ddl
from strata.errors import LateRows
from strata.functions import utc_date, with_provenance
from strata.operators import conform_events


def stream_files(
    spark: SparkSession,
    path: str,
    columns: Sequence[Column],
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files as an endless source; a limit per trigger bounds each micro-batch."""
    reader = spark.readStream.schema(ddl(columns))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_to_bronze(
    messages: DataFrame, source: str | None = None, at: str | None = None
) -> DataFrame:
    """Messages as they come, plus provenance. A broker has no file, so give ``source`` there."""
    return with_provenance(messages, source, at)


def stream_to_silver(bronze: DataFrame, at: str | None = None) -> DataFrame:
    return conform_events(bronze, at)


def daily_throughput(
    events: DataFrame, time: str = "ts", late_by: str = "1 day", every: str = "1 day"
) -> DataFrame:
    """Events per window of event time, each window emitted once the watermark has passed it."""
    return (
        events.withWatermark(time, late_by)
        .groupBy(F.window(time, every))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            utc_date(F.col("window.start")).alias("event_date"),
            "event_count",
        )
    )


def open_windows(
    events: DataFrame, time: str = "ts", late_by: str = "1 day", every: str = "1 day"
) -> DataFrame:
    """In batch: windows the watermark of these events has not passed, and their events so far."""
    watermark = events.agg((F.max(time) - F.expr(f"INTERVAL {late_by}")).alias("t")).scalar()
    return (
        events.groupBy(F.window(time, every))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .where(F.col("window.end") > watermark)
        .select(utc_date(F.col("window.start")).alias("event_date"), "event_count")
    )


def to_parquet(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Append to a folder exactly once; a restart goes on from ``checkpoint``."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return writer.partitionBy(*partition_by) if partition_by else writer


_PROGRESS = "spark.sql.streaming.numRecentProgressUpdates"


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over all batches whose progress is kept.

    Spark counts them after combining inside a task, so one row may stand for several events.
    """
    return sum(
        int(state.get("numRowsDroppedByWatermark", 0))
        for progress in query.recentProgress
        for state in json.loads(progress.json)["stateOperators"]
    )


def run_available(writer: DataStreamWriter, allow_late: bool = False) -> StreamingQuery:
    """Work through everything there is now, then stop.

    The progress of every batch is kept for this run; rows that came behind the watermark raise
    ``LateRows`` (after the run: what is written stays) unless they are allowed.
    """
    spark = SparkSession.active()
    kept = spark.conf.get(_PROGRESS)
    spark.conf.set(_PROGRESS, "1000000")
    try:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        late = late_rows(query)
    finally:
        spark.conf.set(_PROGRESS, kept)
    if late and not allow_late:
        raise LateRows(f"{late} rows came behind the watermark and are not in the result")
    return query
