"""Plans that must hold at any size."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from strata.operators import carrier_summary, conform_flights, distinct_keys
from strata.plans.flights import FLIGHTS, build_flights_silver, ingest_flights
from strata.queries import ORACLES, QUERIES
from strata.sinks import write_layer
from strata.sources import read_layer
from tests.conftest import plan_of

SMALL = "/root/testdata/sf0.001"


def logical(df) -> str:
    return df._jdf.queryExecution().toString()


def test_gold_reads_only_its_columns_and_combines_before_the_shuffle(spark, lake, flights_csv):
    ingest_flights(spark, lake, flights_csv)
    build_flights_silver(spark, lake)
    gold = carrier_summary(read_layer(spark, lake.path(FLIGHTS.at("silver"))))
    gold.collect()
    plan = plan_of(gold)
    assert (
        "ReadSchema: struct<carrier:string,dep_delay_minutes:double,arr_delay_minutes:double,"
        "cancelled_flag:double,distance_miles:double>" in plan
    )
    assert "partial_avg" in plan and plan.count("Exchange hashpartitioning") >= 1
    distinct = distinct_keys(read_layer(spark, lake.path(FLIGHTS.at("silver"))), "carrier", "n")
    assert "ReadSchema: struct<carrier:string>" in logical(distinct)


def test_filter_on_a_conformed_string_reaches_the_scan(spark, lake, flights_csv):
    ingest_flights(spark, lake, flights_csv)
    df = conform_flights(read_layer(spark, lake.path(FLIGHTS))).where("carrier = 'WN'")
    assert "EqualTo(op_unique_carrier,WN)" in logical(df)


def test_conform_and_unpartitioned_write_do_not_shuffle(spark, lake, flights_csv):
    ingest_flights(spark, lake, flights_csv)
    df = conform_flights(read_layer(spark, lake.path(FLIGHTS)))
    assert "Exchange" not in plan_of(df)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_rows_or_runs_python_per_row(spark, name):
    plan = logical(QUERIES[name](spark, SMALL))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in plan, forbidden


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "carrier" in df.columns


def test_counter_is_above_the_shuffle_of_a_partitioned_write(spark, tmp_path):
    """Below it, a map task run again after a lost executor would be counted twice."""
    from pyspark.sql import Observation

    df = spark.range(10).withColumn("k", F.col("id") % 2).hint("rebalance", "k")
    seen = df.observe(Observation("x"), F.count(F.lit(1)).alias("n"))
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")
    assert write_layer(df, str(tmp_path / "t"), partition_by=["k"]).rows == 10
