"""Landing: scans, CSV ingest, provenance, day folders, file inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import snake_case_columns, with_names, with_provenance
from strata.lake import DatasetRef
from strata.operators import rows_per_key
from strata.plans.events import EVENTS, land_events
from strata.plans.flights import FLIGHTS, ingest_csv, ingest_flights
from strata.queries.base import (
    EVENTS_TABLE,
    FLIGHTS_CTE,
    LOADED_AT,
    events,
    flights,
    query,
    sample_events,
    staged_flights,
    table,
)
from strata.queries.layers import conformed_events, landed_events
from strata.sinks import land_day, write_layer
from strata.sources import (
    file_inventory,
    inventory_by_partition,
    read_layer,
    read_partition,
    read_partitioned,
)
from strata.workspace import scratch_lake

EVENT_ROWS = "SELECT event_id, user_id, event_type, value, props FROM events"
ROWS_PER_DT = """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS row_count FROM events GROUP BY 1
"""
FLIGHT_COLUMNS = [
    "op_unique_carrier",
    "origin",
    "dest",
    "dep_delay_new",
    "arr_delay_new",
    "cancelled",
    "distance",
]


@query(
    "SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events"
)
def bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("string"), "user_id", "event_type", "value", "props"
    )


@query(FLIGHTS_CTE + "SELECT * FROM flights")
def bronze_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "csv")
    ingest_flights(spark, lake, staged_flights(spark, sf_dir, lake), at=LOADED_AT)
    return read_layer(spark, lake.path(FLIGHTS)).select(*FLIGHT_COLUMNS)


@query(
    FLIGHTS_CTE
    + """
SELECT op_unique_carrier AS OP_UNIQUE_CARRIER, origin AS ORIGIN, dest AS DEST,
       dep_delay_new AS DEP_DELAY_NEW, arr_delay_new AS ARR_DELAY_NEW,
       cancelled AS CANCELLED, distance AS DISTANCE, 'staging/flights' AS source_file
FROM flights
"""
)
def bronze_csv_ingest_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "csv_all")
    ref = DatasetRef("bronze", "aviation", "flights_as_received")
    source = staged_flights(spark, sf_dir, lake)
    ingest_csv(spark, lake, ref, source, label="staging/flights", at=LOADED_AT, rename=False)
    return read_layer(spark, lake.path(ref)).drop("ingest_ts")


@query(FLIGHTS_CTE + "SELECT * FROM flights")
def bronze_snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir)
    return snake_case_columns(rows.toDF(*[c.upper() for c in rows.columns]))


@query(
    FLIGHTS_CTE
    + """
SELECT op_unique_carrier, distance, 'lineitem.parquet' AS source_file,
       '2026-03-02 00:00:00' AS ingest_ts
FROM flights
"""
)
def bronze_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_provenance(flights(spark, sf_dir), "lineitem.parquet", LOADED_AT)
    stamp = F.date_format("ingest_ts", "yyyy-MM-dd HH:mm:ss").alias("ingest_ts")
    return rows.select("op_unique_carrier", "distance", "source_file", stamp)


@query(EVENT_ROWS)
def parquet_overwrite_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "overwrite")
    path = lake.path(DatasetRef("bronze", "demo", "events"))
    source = f"{sf_dir}/events.parquet"
    for _ in range(2):
        write_layer(events(spark, sf_dir), path, reads=[source])
    return read_layer(spark, path, EVENTS_TABLE).drop("ts")


@query(ROWS_PER_DT)
def landing_partition_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days land in their folders; then the last day lands once more in place."""
    lake = scratch_lake(spark, "landing")
    rows = sample_events(spark, sf_dir)
    land_events(rows, lake)
    last = rows.agg(F.max("dt")).first()[0]
    land_day(rows, lake.path(EVENTS), last, skip_others=True)
    return rows_per_key(read_partitioned(spark, lake.path(EVENTS), {"dt": "string"}), "dt")


@query(
    """
SELECT event_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt FROM events
"""
)
def partition_discovery_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = landed_events(spark, sf_dir)
    found = read_partitioned(spark, lake.path(EVENTS), {"dt": "string"})
    return found.select("event_id", "value", "dt")


@query("SELECT event_id AS id, value, 'events' AS source, '2026-03-02' AS dt FROM events")
def rename_and_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed columns and constants beside columns of the table."""
    names = {"event_id": "id", "value": "value"}
    return with_names(table(spark, sf_dir, "events"), names, {"source": "events", "dt": "2026-03-02"})


@query(
    """
SELECT lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour, count(*) AS row_count,
       (SELECT count(*) FROM events WHERE hour(ts) = 7) AS at_seven
FROM events GROUP BY 1
"""
)
def padded_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders ``hour=00`` to ``hour=23`` come back as text, and '07' finds its folder."""
    path = scratch_lake(spark, "hours").path(DatasetRef("bronze", "demo", "hourly_events"))
    hourly = events(spark, sf_dir).select("event_id", F.date_format("ts", "HH").alias("hour"))
    write_layer(hourly, path, partition_by=["hour"])
    seven = read_partition(spark, path, "hour", "07").count()
    found = rows_per_key(read_partitioned(spark, path, {"hour": "string"}), "hour")
    return found.withColumn("at_seven", F.lit(seven).cast("bigint"))


@query(
    """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, CAST(count(*) AS BIGINT) AS row_count,
       TRUE AS files_differ, TRUE AS files_have_bytes
FROM events GROUP BY 1
"""
)
def lake_file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = landed_events(spark, sf_dir)
    files = file_inventory(spark, lake.path(EVENTS), ["dt"])
    return files.groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt")).agg(
        F.sum("row_count").alias("row_count"),
        (F.count_distinct("file_path") == F.count("*")).alias("files_differ"),
        (F.min("file_bytes") > 0).alias("files_have_bytes"),
    )


@query(
    """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS row_count, TRUE AS has_bytes
FROM events GROUP BY 1
"""
)
def lake_inventory_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = conformed_events(spark, sf_dir)
    files = file_inventory(spark, lake.path(EVENTS.at("silver")), ["event_date"])
    return inventory_by_partition(files, "event_date").select(
        "event_date", "row_count", (F.col("total_bytes") > 0).alias("has_bytes")
    )
