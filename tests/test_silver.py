from datetime import date

import pytest
from pyspark.sql import functions as F

from strata.contracts import EVENTS_SILVER, FLIGHTS_SILVER, Conform, check_schema
from strata.operators import (
    conform,
    conform_events,
    conform_flights,
    null_profile,
    quality_profile,
)
from strata.plans.flights import FLIGHTS, build_flights_silver, ingest_flights
from strata.sinks import write_layer
from strata.sources import read_layer


@pytest.fixture
def bronze(spark, lake, flights_csv):
    ingest_flights(spark, lake, flights_csv)
    return read_layer(spark, lake.path(FLIGHTS))


def test_flights_get_names_types_and_keep_nulls(bronze):
    silver = conform_flights(bronze)
    check_schema(silver, FLIGHTS_SILVER)
    assert silver.columns == [c.name for c in FLIGHTS_SILVER]
    rows = {r.carrier: r for r in silver.collect()}
    assert rows["WN"].dep_delay_minutes == 82.0 and rows["WN"].distance_miles == 1999.0
    assert rows["AA"].dep_delay_minutes is None and rows["AA"].arr_delay_minutes is None
    assert rows["AA"].cancelled_flag == 1.0
    assert null_profile(silver).first().dep_delay_minutes_nulls == 1


def test_value_that_does_not_fit_becomes_null_and_is_counted(spark):
    df = spark.createDataFrame([("1", "2026-03-02"), ("x", "soon"), (None, None)], "event_id string, dt string")
    rows = conform_events(df, rejects="_rejects").orderBy("_rejects", F.col("event_id").desc()).collect()
    assert [(r.event_id, r.event_date, r._rejects) for r in rows] == [
        (1, date(2026, 3, 2), 0),
        (None, None, 0),
        (None, None, 2),
    ]


def test_events_contract(spark):
    df = spark.createDataFrame([(7, "2026-03-02")], "event_id int, dt string")
    check_schema(conform_events(df), EVENTS_SILVER)


def test_conform_takes_any_mapping(spark):
    df = spark.createDataFrame([("5", 1)], "a string, b int")
    out = conform(df, [Conform("b", "string", "text"), Conform("a", "double", "number")])
    assert out.columns == ["text", "number"] and tuple(out.first()) == ("1", 5.0)


def test_silver_job_counts_rejects_in_the_write(spark, lake):
    rows = [("WN", "PHX", "BWI", "82", 57.0, 0.0, 1.0), ("AA", "ABQ", "DFW", "n/a", None, 1.0, 2.0)]
    names = "op_unique_carrier string, origin string, dest string, dep_delay_new string, arr_delay_new double, cancelled double, distance double"
    bronze = spark.createDataFrame(rows, names).selectExpr(
        "*", "'f.csv' AS source_file", "timestamp'2026-03-02 00:00:00' AS ingest_ts"
    )
    write_layer(bronze, lake.path(FLIGHTS))
    result = build_flights_silver(spark, lake)
    assert result.rows == 2 and result.metrics == {"rejects": 1}
    check_schema(read_layer(spark, result.path), FLIGHTS_SILVER)


def test_quality_profile_against_brute_force(spark):
    values = ["1", "2.5", None, "x", "", " 3 ", "nan", "1e3"]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    row = quality_profile(df, [Conform("a", "double", "n")]).first()

    def fits(v):
        try:
            float(v)
            return True
        except ValueError:
            return False

    known = [v for v in values if v is not None]
    assert row.row_count == len(values)
    assert row.n_rejects == sum(not fits(v) for v in known)
    assert row.n_nulls == row.n_rejects + values.count(None)


def test_quality_profile_of_nothing(spark):
    row = quality_profile(spark.createDataFrame([], "a string"), [Conform("a", "double", "n")]).first()
    assert tuple(row) == (0, 0, 0)
