"""Reconciliation, quality and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import register_table
from strata.contracts import FLIGHTS_CONFORM
from strata.functions import with_provenance
from strata.lake import DatasetRef
from strata.operators import conform_flights, lineage, quality_profile
from strata.plans.datasets import build_gold, build_silver, ingest_text, parse_mapping
from strata.plans.flights import FLIGHTS, flights_report, run_flights
from strata.queries import base
from strata.queries.base import (
    FLIGHTS_CTE,
    LOADED_AT,
    flights,
    query,
    staged_flights,
    table,
)
from strata.sinks import write_layer
from strata.sources import read_layer
from strata.workspace import scratch_lake

# Flights whose departure delay came as text that is not always a number.
TEXT_FLIGHTS = tuple(
    """CASE WHEN l_quantity > 45 THEN NULL
            WHEN l_quantity < 3 THEN 'n/a'
            ELSE CAST(l_quantity AS STRING) END AS dep_delay_new"""
    if column.endswith("dep_delay_new")
    else column
    for column in base.FLIGHTS
)


@query(
    """
SELECT count(*) AS row_count, count(*) FILTER (WHERE l_quantity < 3) AS rejects,
       CAST(0 AS BIGINT) AS malformed,
       count(*) FILTER (WHERE l_quantity < 3) AS raw_text_kept
FROM lineitem
"""
)
def bronze_csv_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text among the delays, columns in another order and one too many: raw text stays in bronze,
    and silver counts what is no number."""
    lake = scratch_lake(spark, "dirty")
    rows = table(spark, sf_dir, "lineitem").selectExpr(*TEXT_FLIGHTS, "l_orderkey AS remark")
    source = f"{lake.root}/staging/dirty"
    upper = [F.col(c).alias(c.upper()) for c in sorted(rows.columns)]
    rows.select(*upper).write.option("header", True).csv(source)
    columns = [f.source for f in FLIGHTS_CONFORM][:-2]
    bronze = ingest_text(spark, lake, FLIGHTS, source, columns, at=LOADED_AT)
    silver = build_silver(spark, lake, FLIGHTS, FLIGHTS_CONFORM)
    kept = read_layer(spark, lake.path(FLIGHTS)).agg(
        F.count_if(F.col("dep_delay_new") == "n/a").alias("raw_text_kept")
    )
    return kept.select(
        F.lit(silver.rows).cast("bigint").alias("row_count"),
        F.lit(silver.metrics["rejects"]).cast("bigint").alias("rejects"),
        F.lit(bronze.metrics["malformed"]).cast("bigint").alias("malformed"),
        "raw_text_kept",
    )


@query(
    """
SELECT o_orderpriority AS priority, count(*) AS order_count,
       CAST(sum(o_custkey) AS BIGINT) AS customer_sum
FROM orders GROUP BY 1
"""
)
def generic_dataset_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders from CSV through bronze and silver to gold by a mapping and a SELECT alone."""
    lake, ref = scratch_lake(spark, "generic"), DatasetRef("bronze", "shop", "orders")
    source = f"{lake.root}/staging/orders"
    table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    ).write.option("header", True).csv(source)
    ingest_text(spark, lake, ref, source, at=LOADED_AT)
    mapping = ["o_orderkey:bigint:order_key", "o_custkey:bigint:customer", "o_orderpriority:string:priority"]
    build_silver(spark, lake, ref, parse_mapping(mapping))
    register_table(spark, lake, ref.at("silver"))
    gold = DatasetRef("gold", "shop", "orders_by_priority")
    build_gold(
        spark,
        lake,
        gold,
        "SELECT priority, count(*) AS order_count, sum(customer) AS customer_sum"
        " FROM identifier(:silver || '.shop_orders') GROUP BY priority",
    )
    return read_layer(spark, lake.path(gold))


@query(
    FLIGHTS_CTE
    + """
SELECT count(*) AS bronze_rows, count(*) AS silver_rows, count(*) AS gold_total,
       count(DISTINCT op_unique_carrier) AS gold_rows, TRUE AS reconciled
FROM flights
"""
)
def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_lake(spark, "reconcile")
    run_flights(spark, lake, staged_flights(spark, sf_dir, lake), "staging/flights", LOADED_AT)
    return flights_report(spark, lake)


@query(
    """
SELECT count(*) AS row_count,
       count(*) - count(l_suppkey) AS carrier_nulls,
       CAST(0 AS BIGINT) AS carrier_rejects,
       count(*) - count(l_returnflag) AS origin_nulls,
       CAST(0 AS BIGINT) AS origin_rejects,
       count(*) - count(l_linestatus) AS dest_nulls,
       CAST(0 AS BIGINT) AS dest_rejects,
       count(*) FILTER (WHERE l_quantity > 45 OR l_quantity < 3) AS dep_delay_minutes_nulls,
       count(*) FILTER (WHERE l_quantity < 3) AS dep_delay_minutes_rejects,
       count(*) FILTER (WHERE l_quantity > 45) AS arr_delay_minutes_nulls,
       CAST(0 AS BIGINT) AS arr_delay_minutes_rejects,
       CAST(0 AS BIGINT) AS cancelled_flag_nulls,
       CAST(0 AS BIGINT) AS cancelled_flag_rejects,
       count(*) - count(l_extendedprice) AS distance_miles_nulls,
       CAST(0 AS BIGINT) AS distance_miles_rejects
FROM lineitem
""",
    name="quality_profile",
)
def quality_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").selectExpr(*TEXT_FLIGHTS)
    fields = [f for f in FLIGHTS_CONFORM if f.source in rows.columns]
    return quality_profile(rows, fields)


@query(
    """
SELECT 'bronze' AS layer, 'lineitem.parquet' AS source_file, count(*) AS row_count FROM lineitem
UNION ALL
SELECT 'silver', 'lineitem.parquet', count(*) FROM lineitem
"""
)
def lineage_rows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's own file, followed from bronze to silver."""
    lake = scratch_lake(spark, "lineage")
    bronze, silver = lake.path(FLIGHTS), lake.path(FLIGHTS.at("silver"))
    write_layer(with_provenance(flights(spark, sf_dir), at=LOADED_AT), bronze)
    write_layer(conform_flights(read_layer(spark, bronze)), silver, reads=[bronze])
    report = lineage({"bronze": read_layer(spark, bronze), "silver": read_layer(spark, silver)})
    return report.drop("last_ingest_ts")
