"""Writes to topics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import TOPIC_MESSAGES, check_schema
from strata.functions import stamp
from strata.lake import Lake, check_topic
from strata.sinks.layers import JobResult, write_layer
from strata.sources.topics import read_topic, topic_summary
from strata.workspace import delete_folder, is_complete

_ENDS = "partition int, end bigint"


def messages(
    spark: SparkSession,
    topic: str,
    n: int,
    prefix: str = "event_",
    partitions: int = 1,
    at: str | None = None,
) -> DataFrame:
    """``prefix1`` ... ``prefixN`` dealt round-robin to partitions, offsets from 0 in each.

    Offsets come from arithmetic on the row number, so no task has to see a whole partition.
    """
    nth = F.col("id")
    return spark.range(n).select(
        F.lit(check_topic(topic)).alias("topic"),
        (nth % partitions).cast("int").alias("partition"),
        F.expr(f"id div {int(partitions)}").alias("offset"),
        F.lit(None).cast("string").alias("key"),
        F.concat(F.lit(prefix), nth + 1).alias("value"),
        stamp(at).alias("timestamp"),
    )


def publish(df: DataFrame, lake: Lake, topic: str) -> JobResult:
    """Append messages that already carry their offsets to the file-backed log."""
    return _append(df, lake, topic)


def produce(
    spark: SparkSession,
    lake: Lake,
    topic: str,
    n: int = 10,
    prefix: str = "event_",
    partitions: int = 1,
    at: str | None = None,
) -> JobResult:
    """Append ``n`` messages after those already in the log. One producer per topic at a time."""
    new = messages(spark, topic, n, prefix, partitions, at)
    ends = log_ends(spark, lake, topic)
    if ends:
        pairs = [F.lit(x) for p, end in sorted(ends.items()) for x in (p, end)]
        base = F.coalesce(F.create_map(*pairs)[F.col("partition")], F.lit(0))
        new = new.withColumn("offset", (F.col("offset") + base).cast("bigint"))
    result = _append(new, lake, topic)
    dealt = {p: (n - p + partitions - 1) // partitions for p in range(partitions)}
    _keep_ends(spark, lake, topic, {p: ends.get(p, 0) + dealt.get(p, 0) for p in {*ends, *dealt}})
    return result


def append_rows(df: DataFrame, lake: Lake, topic: str, nth: str) -> JobResult:
    """Append messages to partition 0 after those in the log; ``nth`` numbers them from 0.

    The new end of the log is counted during the write. One producer per topic at a time.
    """
    spark = df.sparkSession
    ends = log_ends(spark, lake, topic)
    offset = (F.col(nth) + ends.get(0, 0)).cast("bigint")
    rows = df.withColumns(
        {"topic": F.lit(check_topic(topic)), "partition": F.lit(0), "offset": offset}
    ).select(*[c.name for c in TOPIC_MESSAGES])
    result = _append(rows, lake, topic)
    last = result.metrics["last"]
    if last is not None:
        ends[0] = last + 1
    _keep_ends(spark, lake, topic, ends)
    return result


def log_ends(spark: SparkSession, lake: Lake, topic: str) -> dict[int, int]:
    """Next offset of each partition, from the note beside the log.

    The note goes before every append and comes back after it, so a log that was last written by
    ``publish``, or by a job that was lost on the way, has none; then the log itself is asked.
    """
    note = lake.ends_path(topic)
    if is_complete(spark, note):
        rows = spark.read.schema(_ENDS).parquet(note).collect()
        return {row["partition"]: row["end"] for row in rows}
    summary = topic_summary(_log_or_empty(spark, lake, topic)).collect()
    return {row["partition"]: row["max_offset"] + 1 for row in summary}


def _keep_ends(spark: SparkSession, lake: Lake, topic: str, ends: dict[int, int]) -> None:
    rows = spark.createDataFrame(sorted(ends.items()), _ENDS)
    rows.coalesce(1).write.mode("overwrite").parquet(lake.ends_path(topic))


def _append(df: DataFrame, lake: Lake, topic: str) -> JobResult:
    check_schema(df, TOPIC_MESSAGES)
    delete_folder(df.sparkSession, lake.ends_path(topic))
    last = {"last": F.max("offset")}
    return write_layer(df, lake.topic_path(topic), mode="append", metrics=last)


def _log_or_empty(spark: SparkSession, lake: Lake, topic: str) -> DataFrame:
    try:
        return read_topic(spark, lake, topic)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return messages(spark, topic, 0)


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send key and value to a broker, which assigns the offsets. Needs the connector jar."""
    (
        df.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", check_topic(topic))
        .save()
    )
