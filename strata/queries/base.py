"""Registry, and the given tables in the roles the flows need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import Column
from strata.functions import utc_date, with_provenance
from strata.lake import Lake
from strata.operators import conform_flights
from strata.sources import read_layer

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOADED_AT = "2026-03-02 00:00:00"

EVENTS_TABLE = (
    Column("event_id", "bigint"),
    Column("ts", "timestamp"),
    Column("user_id", "bigint"),
    Column("event_type", "string"),
    Column("value", "double"),
    Column("props", "string"),
)

# Line items in the role of flights: suppliers are carriers, large quantities are cancelled
# flights, whose delays are unknown. The same expressions run in Spark and in the oracle.
FLIGHTS = (
    "concat('S', CAST(l_suppkey AS STRING)) AS op_unique_carrier",
    "l_returnflag AS origin",
    "l_linestatus AS dest",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity END AS dep_delay_new",
    "CASE WHEN l_quantity > 45 THEN NULL ELSE l_tax * 100 END AS arr_delay_new",
    "CASE WHEN l_quantity > 45 THEN 1.0E0 ELSE 0.0E0 END AS cancelled",
    "l_extendedprice AS distance",
)

FLIGHTS_CTE = "WITH flights AS (SELECT " + ",\n".join(FLIGHTS) + " FROM lineitem)\n"


def rounded(column: str, places: int) -> SqlColumn:
    """Doubles to compare: their last digits depend on the order of the sum.

    The nudge keeps an exact half from going up in one order and down in another.
    """
    return F.round(F.col(column) + F.lit(1e-9), places).alias(column)


def rounded_sql(value: str, places: int) -> str:
    """The same in the oracle."""
    return f"round({value} + 1e-9, {places})"


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; without ``oracle`` only its rows are checked."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*FLIGHTS)


def silver_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_flights(with_provenance(flights(spark, sf_dir), "lineitem.parquet", LOADED_AT))


def staged_flights(spark: SparkSession, sf_dir: str, lake: Lake) -> str:
    """The flights as CSV files with upper-case headers; returns their folder."""
    path = f"{lake.root}/staging/flights"
    rows = flights(spark, sf_dir)
    rows.toDF(*[c.upper() for c in rows.columns]).write.option("header", True).csv(path)
    return path


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with ``ts`` as an instant in UTC."""
    return read_layer(spark, f"{sf_dir}/events.parquet", EVENTS_TABLE)


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "ts", "value", utc_date(F.col("ts")).cast("string").alias("dt")
    )


def event_messages(df: DataFrame) -> DataFrame:
    """Events as messages of one topic; the event number is the offset."""
    return df.select(
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("value"),
        F.col("ts").alias("timestamp"),
    )
