"""Topics: an ordered log of string messages, read from Parquet or from a Kafka-style broker."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import TOPIC_MESSAGES, ddl
from strata.lake import Lake, check_topic


def read_topic(
    spark: SparkSession,
    lake: Lake,
    topic: str,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """File-backed log of one topic, as a batch or as a stream."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(ddl(TOPIC_MESSAGES)).parquet(lake.topic_path(topic))


def read_all_topics(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every file-backed topic of the lake as one log."""
    return spark.read.schema(ddl(TOPIC_MESSAGES)).parquet(f"{lake.topics_path}/*")


def kafka_options(
    servers: str,
    topic: str,
    stream: bool,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    ending: Mapping[int, int] | None = None,
) -> dict[str, str]:
    """Source options for a broker; a bounded read ends at the offsets known when it starts, or at
    those in ``ending``, by partition: the way to look at first messages without the whole topic."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": check_topic(topic),
        "startingOffsets": starting,
    }
    if not stream:
        bounds = {topic: {str(p): end for p, end in (ending or {}).items()}}
        options["endingOffsets"] = json.dumps(bounds) if ending else "latest"
    elif max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_kafka(
    spark: SparkSession, servers: str, topic: str, stream: bool = False, **options
) -> DataFrame:
    """Broker topic with the columns of the file-backed log. Needs the Kafka connector jar."""
    reader = spark.readStream if stream else spark.read
    raw = reader.format("kafka").options(**kafka_options(servers, topic, stream, **options)).load()
    return raw.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in TOPIC_MESSAGES])


def first_ends(starts: Mapping[int, int], n: int) -> dict[int, int]:
    """Where a bounded read of the first ``n`` messages may stop, from each partition's first offset:
    no later message of a partition can be among them. Offsets may have gaps, so it is an upper
    bound only for logs without (a compacted topic needs the whole range)."""
    return {partition: start + n for partition, start in starts.items()}


def consume_kafka(
    spark: SparkSession, servers: str, topic: str, starts: Mapping[int, int], n: int = 10
) -> DataFrame:
    """First ``n`` messages of a broker topic in one bounded read: at most ``n`` per partition."""
    log = read_kafka(spark, servers, topic, ending=first_ends(starts, n))
    return consume(log, n, look_first=False)


def consume(log: DataFrame, n: int = 10, look_first: bool = True) -> DataFrame:
    """First ``n`` messages in log order. Each task keeps ``n`` rows, so ``n`` is for looking.

    A first look at the three order columns finds the highest offset that can be among them;
    with it the scan for whole messages skips what lies beyond. A source that cannot leave columns
    unread (a broker) is read once without that look: turn ``look_first`` off.
    """
    order = ["topic", "partition", "offset"]
    if not look_first:
        return log.orderBy(*order).limit(n)
    last = log.select(*order).orderBy(*order).limit(n).agg(F.max("offset")).scalar()
    return log.where(F.col("offset") <= last).orderBy(*order).limit(n)


def topic_summary(log: DataFrame) -> DataFrame:
    """Topics and partitions with offset range and message count, combined before the shuffle."""
    return log.groupBy("topic", "partition").agg(
        F.min("offset").alias("min_offset"),
        F.max("offset").alias("max_offset"),
        F.count(F.lit(1)).alias("message_count"),
    )
