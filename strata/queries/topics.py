"""Topics, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import utc_date
from strata.lake import DatasetRef
from strata.plans.events import EVENTS
from strata.queries.base import (
    EVENTS_TABLE,
    event_messages,
    events,
    query,
)
from strata.sinks import append_rows, publish
from strata.sources import consume, read_layer, read_topic, topic_summary
from strata.streaming import (
    daily_throughput,
    open_windows,
    run_available,
    stream_files,
    stream_to_bronze,
    stream_to_silver,
    to_parquet,
)
from strata.workspace import scratch_lake

# Bounds each micro-batch of a stateless stream, so a backlog is worked off in restartable steps.
FILES_PER_BATCH = 1000


PRODUCED = """
SELECT 'events' AS topic, CAST(0 AS INTEGER) AS "partition", {offset} AS "offset",
       CAST(user_id AS VARCHAR) AS "key", event_type AS value
FROM events
"""


@query(
    PRODUCED.format(offset="event_id")
    + "UNION ALL"
    + PRODUCED.format(offset="event_id + (SELECT max(event_id) + 1 FROM events)")
)
def topic_produce_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as messages after a log that has them already: its offsets go on."""
    lake = scratch_lake(spark, "produce")
    rows = event_messages(events(spark, sf_dir))
    publish(rows, lake, "events")
    append_rows(rows.withColumnRenamed("offset", "nth"), lake, "events", "nth")
    return read_topic(spark, lake, "events").drop("timestamp")


@query(
    """
SELECT 'events' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset",
       CAST(user_id AS VARCHAR) AS "key", event_type AS value
FROM events ORDER BY event_id LIMIT 10
"""
)
def topic_consume_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consume(event_messages(events(spark, sf_dir))).drop("timestamp")


@query(
    """
SELECT event_type AS topic, CAST(0 AS INTEGER) AS "partition", min(event_id) AS min_offset,
       max(event_id) AS max_offset, count(*) AS message_count
FROM events GROUP BY event_type
""",
    name="topic_summary",
)
def topic_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_messages(events(spark, sf_dir)).withColumn("topic", F.col("value"))
    return topic_summary(log)


@query(
    """
SELECT 'events' AS topic, CAST(0 AS INTEGER) AS "partition", event_id AS "offset",
       CAST(user_id AS VARCHAR) AS "key", event_type AS value, 'events' AS source_file
FROM events
"""
)
def stream_bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic log to bronze; the second run finds nothing new and adds nothing."""
    lake = scratch_lake(spark, "stream_bronze")
    publish(event_messages(events(spark, sf_dir)), lake, "events")
    target = lake.path(DatasetRef("bronze", "demo", "topic_events"))
    for _ in range(2):
        log = read_topic(spark, lake, "events", True, FILES_PER_BATCH)
        bronze = stream_to_bronze(log, "events")
        run_available(to_parquet(bronze, target, lake.checkpoint_path("topic_events")))
    return read_layer(spark, target).drop("timestamp", "ingest_ts")


@query("SELECT event_id, CAST(ts AS DATE) AS event_date FROM events")
def stream_silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "stream_silver")
    source = stream_files(spark, f"{sf_dir}/events*.parquet", EVENTS_TABLE, FILES_PER_BATCH)
    bronze = source.withColumn("dt", utc_date(F.col("ts")).cast("string"))
    target = lake.path(EVENTS.at("silver"))
    writer = to_parquet(stream_to_silver(bronze), target, lake.checkpoint_path("silver_events"))
    run_available(writer)
    return read_layer(spark, target).drop("ingest_ts")


@query(
    """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count
FROM events
GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
"""
)
def stream_daily_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days the watermark has passed; the last days stay open (``stream_open_windows``).

    No file limit here: over one batch no event is late, in whatever order the files come.
    """
    lake = scratch_lake(spark, "throughput")
    source = stream_files(spark, f"{sf_dir}/events*.parquet", EVENTS_TABLE)
    target = lake.path(DatasetRef("gold", "demo", "daily_throughput"))
    writer = to_parquet(daily_throughput(source), target, lake.checkpoint_path("throughput"))
    run_available(writer)
    return read_layer(spark, target).select("event_date", "event_count")


@query(
    """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count
FROM events
GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY > (SELECT max(ts) FROM events) - INTERVAL 1 DAY
"""
)
def stream_open_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that ``stream_daily_throughput`` has not given out yet."""
    return open_windows(events(spark, sf_dir))
