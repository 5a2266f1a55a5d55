"""Conforming: typed, renamed, date-partitioned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import conform_events, null_profile, rows_per_key
from strata.plans.events import EVENTS, build_events_silver, land_events
from strata.queries.base import FLIGHTS_CTE, LOADED_AT, query, sample_events, silver_flights
from strata.queries.layers import conformed_events
from strata.sources import read_layer, read_partition
from strata.workspace import scratch_lake

SILVER_EVENTS = "SELECT event_id, CAST(ts AS DATE) AS event_date FROM events"


def _shared_silver(spark: SparkSession, sf_dir: str) -> str:
    return conformed_events(spark, sf_dir).path(EVENTS.at("silver"))


@query(SILVER_EVENTS)
def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_events(sample_events(spark, sf_dir), LOADED_AT).drop("ingest_ts")


@query(SILVER_EVENTS)
def silver_events_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "silver")
    land_events(sample_events(spark, sf_dir), lake)
    path = build_events_silver(spark, lake, LOADED_AT).path
    return read_layer(spark, path).select("event_id", "event_date")


@query(
    FLIGHTS_CTE
    + """
SELECT op_unique_carrier AS carrier, origin, dest, dep_delay_new AS dep_delay_minutes,
       arr_delay_new AS arr_delay_minutes, cancelled AS cancelled_flag,
       distance AS distance_miles, 'lineitem.parquet' AS source_file
FROM flights
"""
)
def silver_flights_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_flights(spark, sf_dir).drop("ingest_ts")


@query(
    FLIGHTS_CTE
    + """
SELECT count(*) AS row_count,
       count(*) - count(op_unique_carrier) AS carrier_nulls,
       count(*) - count(origin) AS origin_nulls,
       count(*) - count(dest) AS dest_nulls,
       count(*) - count(dep_delay_new) AS dep_delay_minutes_nulls,
       count(*) - count(arr_delay_new) AS arr_delay_minutes_nulls,
       count(*) - count(cancelled) AS cancelled_flag_nulls,
       count(*) - count(distance) AS distance_miles_nulls
FROM flights
"""
)
def silver_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(silver_flights(spark, sf_dir).drop("source_file", "ingest_ts"))


@query(
    SILVER_EVENTS + " WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"
)
def partition_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day, found and read without opening the other days' data."""
    path = _shared_silver(spark, sf_dir)
    last_day = read_layer(spark, path).select(F.max("event_date")).scalar()
    return read_partition(spark, path, "event_date", last_day).select("event_id", "event_date")


@query("SELECT CAST(ts AS DATE) AS event_date, count(*) AS row_count FROM events GROUP BY 1")
def partition_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _shared_silver(spark, sf_dir)
    return rows_per_key(read_layer(spark, path), "event_date")
