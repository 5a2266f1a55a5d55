"""Catalog tables and SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import (
    ensure_layer,
    register_partitioned_table,
    register_table,
    run_script,
    run_sql,
    sample,
    sync_partitions,
)
from strata.contracts import CARRIER_DELAY_SPREAD, EVENTS_SILVER, ddl
from strata.lake import DatasetRef
from strata.operators import conform_events, profile, row_count
from strata.plans.events import EVENTS
from strata.plans.flights import FLIGHTS
from strata.plans.models import build_all, model_args, model_text
from strata.queries.base import (
    FLIGHTS_CTE,
    LOADED_AT,
    events,
    query,
    rounded,
    rounded_sql,
    sample_events,
    silver_flights,
)
from strata.queries.layers import conformed_events
from strata.sinks import append_table, insert_select, land_day, write_layer
from strata.workspace import scratch_lake

RAW_EVENTS = DatasetRef("bronze", "demo", "events")


@query("SELECT count(*) AS n FROM events")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "count")
    name = register_table(spark, lake, RAW_EVENTS, location=f"{sf_dir}/events.parquet")
    return row_count(spark.table(name))


@query(
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS row_count, "
        f"count({name}) AS non_null_count, count(DISTINCT {name}) AS distinct_count FROM events"
        for name, kind in [
            ("event_id", "bigint"),
            ("ts", "timestamp_ntz"),
            ("user_id", "bigint"),
            ("event_type", "string"),
            ("value", "double"),
            ("props", "string"),
        ]
    )
)
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "profile")
    name = register_table(spark, lake, RAW_EVENTS, location=f"{sf_dir}/events.parquet")
    return profile(spark.table(name))


@query("SELECT least(count(*), 5) AS n, least(count(*), 5) AS of_the_table FROM events")
def table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a sample has, and how many of them the table has too."""
    lake = scratch_lake(spark, "sample")
    name = register_table(spark, lake, RAW_EVENTS, location=f"{sf_dir}/events.parquet")
    found = sample(spark, lake, RAW_EVENTS)
    key = ["event_id", "ts", "user_id", "value"]
    counted = found.agg(F.count("*").alias("n"))
    known = found.join(spark.table(name).select(*key), key, "left_semi")
    return counted.select("n", known.agg(F.count("*")).scalar().alias("of_the_table"))


@query(
    """
SELECT c_mktsegment AS segment, count(*) AS order_count, count(DISTINCT o_custkey) AS customers,
       round(sum(o_totalprice), 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
"""
)
def sql_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "sql")
    names = {
        name: register_table(
            spark,
            lake,
            DatasetRef("bronze", "shop", name),
            location=f"{sf_dir}/{name}.parquet",
        )
        for name in ("orders", "customer")
    }
    return run_sql(
        spark,
        """
        SELECT c_mktsegment AS segment,
               count(*) AS order_count,
               count(DISTINCT o_custkey) AS customers,
               round(sum(o_totalprice), 2) AS total_price
        FROM identifier(:orders) JOIN identifier(:customer) ON o_custkey = c_custkey
        GROUP BY c_mktsegment
        """,
        names,
    )


@query(
    """
SELECT (SELECT count(*) FROM events) AS all_rows,
       (SELECT count(*) FROM events
        WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)) AS day_rows
"""
)
def register_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table over the whole landing folder's source, one over a single landing day."""
    lake = scratch_lake(spark, "external")
    rows = sample_events(spark, sf_dir)
    last_day = rows.agg(F.max("dt")).first()[0]
    land_day(rows, lake.path(EVENTS), last_day, skip_others=True)
    day = register_table(spark, lake, EVENTS, day=last_day)
    every = register_table(spark, lake, RAW_EVENTS, location=f"{sf_dir}/events.parquet")
    return run_sql(
        spark,
        "SELECT (SELECT count(*) FROM identifier(:every)) AS all_rows,"
        " (SELECT count(*) FROM identifier(:day)) AS day_rows",
        {"every": every, "day": day},
    )


@query(
    "SELECT CAST(ts AS DATE) AS event_date, count(*) AS n FROM events GROUP BY 1",
    name="register_partitioned_table",
)
def register_partitioned_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, ref = conformed_events(spark, sf_dir), EVENTS.at("silver")
    name = register_partitioned_table(spark, lake, ref, ["event_date"], EVENTS_SILVER)
    return spark.table(name).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


@query('SELECT CAST(0 AS BIGINT) AS "before", count(*) AS "after" FROM events')
def partition_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake, ref = conformed_events(spark, sf_dir), EVENTS.at("silver")
    name = register_partitioned_table(
        spark, lake, ref, ["event_date"], EVENTS_SILVER, sync=False
    )
    before = spark.table(name).count()
    sync_partitions(spark, lake, ref)
    return row_count(spark.table(name), "after").withColumn("before", F.lit(before).cast("bigint"))


@query("SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def managed_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "append")
    ensure_layer(spark, lake, "bronze")
    name = lake.table(RAW_EVENTS)
    for _ in range(2):
        append_table(events(spark, sf_dir), name)
    return spark.table(name).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _registered_silver_flights(spark: SparkSession, sf_dir: str, label: str):
    lake = scratch_lake(spark, label)
    ref = FLIGHTS.at("silver")
    write_layer(silver_flights(spark, sf_dir), lake.path(ref))
    register_table(spark, lake, ref)
    return lake


@query(
    FLIGHTS_CTE
    + f"""
SELECT op_unique_carrier AS carrier, count(*) AS flight_count,
       {rounded_sql("avg(arr_delay_new)", 6)} AS avg_arr_delay,
       {rounded_sql("avg(dep_delay_new)", 6)} AS avg_dep_delay,
       {rounded_sql("stddev_samp(arr_delay_new)", 6)} AS std_arr_delay,
       {rounded_sql("stddev_samp(dep_delay_new)", 6)} AS std_dep_delay,
       TIMESTAMP '{LOADED_AT}' AS built_at
FROM flights GROUP BY 1
"""
)
def gold_carrier_delay_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table declared by a script and filled from SQL text."""
    lake = _registered_silver_flights(spark, sf_dir, "delay_sql")
    ensure_layer(spark, lake, "gold")
    ref = DatasetRef("gold", "aviation", "carrier_delay_spread")
    name, select = lake.table(ref), model_text(ref.project, ref.name)
    run_script(
        spark,
        f"""
        DROP TABLE IF EXISTS {name};
        CREATE TABLE {name} ({ddl(CARRIER_DELAY_SPREAD)})
        USING parquet LOCATION '{lake.path(ref)}';
        """,
    )
    insert_select(spark, name, select, model_args(lake, LOADED_AT))
    delays = ("avg_arr_delay", "avg_dep_delay", "std_arr_delay", "std_dep_delay")
    return spark.table(name).select(
        "carrier", "flight_count", *[rounded(c, 6) for c in delays], "built_at"
    )


@query(
    """
SELECT 'carrier_delay_spread' AS model, count(DISTINCT l_suppkey) AS n FROM lineitem
UNION ALL SELECT 'carrier_summary', count(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'daily_event_counts', count(DISTINCT CAST(ts AS DATE)) FROM events
"""
)
def gold_build_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The models' row counters, as the builds report them."""
    lake = _registered_silver_flights(spark, sf_dir, "build_all")
    days = conform_events(sample_events(spark, sf_dir), LOADED_AT)
    write_layer(days, lake.path(EVENTS.at("silver")), partition_by=["event_date"])
    register_partitioned_table(spark, lake, EVENTS.at("silver"), ["event_date"])
    built = {
        model: result.rows
        for project in ("aviation", "demo")
        for model, result in build_all(spark, lake, project, LOADED_AT).items()
    }
    return spark.createDataFrame(list(built.items()), "model string, n bigint")
