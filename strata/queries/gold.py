"""Metrics, reports and the two flows from end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import (
    carrier_summary,
    conform_events,
    daily_event_counts,
    distinct_keys,
    rank_by,
    top_by,
    total,
)
from strata.plans.events import EVENTS_GOLD, run_events
from strata.plans.flights import FLIGHTS_GOLD, run_flights
from strata.queries.base import (
    FLIGHTS_CTE,
    LOADED_AT,
    query,
    rounded,
    rounded_sql,
    sample_events,
    silver_flights,
    staged_flights,
)
from strata.sinks import write_layer
from strata.sources import read_layer
from strata.workspace import scratch_lake

DAILY_COUNTS = """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count FROM events GROUP BY 1
"""
SUMMARY = (
    FLIGHTS_CTE
    + f"""
SELECT op_unique_carrier AS carrier, count(*) AS flight_count,
       {rounded_sql("avg(dep_delay_new)", 6)} AS avg_dep_delay_minutes,
       {rounded_sql("avg(arr_delay_new)", 6)} AS avg_arr_delay_minutes,
       sum(cancelled) AS cancelled_count,
       {rounded_sql("avg(distance)", 4)} AS avg_distance_miles
FROM flights GROUP BY 1
"""
)


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.select(
        "carrier",
        "flight_count",
        rounded("avg_dep_delay_minutes", 6),
        rounded("avg_arr_delay_minutes", 6),
        "cancelled_count",
        rounded("avg_distance_miles", 4),
    )


def _stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_lake(spark, "ranking").path(FLIGHTS_GOLD)
    write_layer(carrier_summary(silver_flights(spark, sf_dir), LOADED_AT), path)
    return read_layer(spark, path)


@query(DAILY_COUNTS)
def gold_daily_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = conform_events(sample_events(spark, sf_dir), LOADED_AT)
    return daily_event_counts(silver, LOADED_AT).drop("load_ts")


@query(SUMMARY)
def gold_carrier_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(carrier_summary(silver_flights(spark, sf_dir), LOADED_AT))


@query(
    """
SELECT 'events' AS counted, count(*) AS total FROM events
UNION ALL
SELECT 'flights', count(*) FROM lineitem
"""
)
def gold_rollup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = daily_event_counts(conform_events(sample_events(spark, sf_dir)))
    carriers = carrier_summary(silver_flights(spark, sf_dir))
    return (
        total(days, "event_count", "total")
        .select(F.lit("events").alias("counted"), "total")
        .unionByName(
            total(carriers, "flight_count", "total").select(
                F.lit("flights").alias("counted"), "total"
            )
        )
    )


@query(FLIGHTS_CTE + "SELECT count(DISTINCT op_unique_carrier) AS carriers FROM flights")
def distinct_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_keys(silver_flights(spark, sf_dir), "carrier", "carriers")


@query(
    FLIGHTS_CTE
    + """
SELECT op_unique_carrier AS carrier, count(*) AS flight_count
FROM flights GROUP BY 1 ORDER BY flight_count DESC, carrier LIMIT 10
"""
)
def top_carriers_by_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = carrier_summary(silver_flights(spark, sf_dir), LOADED_AT)
    return top_by(summary, "flight_count", "carrier").select("carrier", "flight_count")


@query(
    FLIGHTS_CTE
    + f"""
, gold AS (
  SELECT op_unique_carrier AS carrier, count(*) AS flight_count,
         {rounded_sql("avg(arr_delay_new)", 6)} AS avg_arr_delay_minutes
  FROM flights GROUP BY 1
)
SELECT *, rank() OVER (ORDER BY flight_count DESC NULLS LAST) AS volume_rank,
       rank() OVER (ORDER BY avg_arr_delay_minutes DESC NULLS LAST) AS delay_rank
FROM gold
"""
)
def gold_carrier_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _rounded(_stored_gold(spark, sf_dir)).select("carrier", "flight_count", "avg_arr_delay_minutes")
    return rank_by(
        gold, {"flight_count": "volume_rank", "avg_arr_delay_minutes": "delay_rank"}
    )


@query(DAILY_COUNTS)
def medallion_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "events")
    run_events(spark, lake, sample_events(spark, sf_dir), LOADED_AT)
    return read_layer(spark, lake.path(EVENTS_GOLD)).drop("load_ts")


@query(SUMMARY)
def medallion_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "flights")
    run_flights(spark, lake, staged_flights(spark, sf_dir, lake), "staging/flights", LOADED_AT)
    return _rounded(read_layer(spark, lake.path(FLIGHTS_GOLD)))
