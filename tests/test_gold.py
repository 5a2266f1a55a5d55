import statistics
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.contracts import CARRIER_DELAY_SPREAD, CARRIER_SUMMARY, DAILY_EVENT_COUNTS
from strata.operators import (
    carrier_delay_spread,
    carrier_summary,
    daily_event_counts,
    describe,
    distinct_keys,
    profile,
    rank_by,
    row_count,
    rows_per_key,
    top_by,
    total,
)

SILVER = "carrier string, dep_delay_minutes double, arr_delay_minutes double, cancelled_flag double, distance_miles double"


@pytest.fixture(scope="module")
def silver(spark):
    rows = [
        ("WN", 82.0, 57.0, 0.0, 1999.0),
        ("WN", 10.0, None, 0.0, 1.0),
        ("AA", None, None, 1.0, 569.0),
        ("AA", None, None, 1.0, 431.0),
        (None, 5.0, 6.0, 0.0, 7.0),
    ]
    return spark.createDataFrame(rows, SILVER)


def test_summary(silver):
    gold = carrier_summary(silver)
    assert gold.dtypes == list(CARRIER_SUMMARY)
    assert dict(gold.dtypes)["cancelled_count"] == "double"
    rows = {r.carrier: tuple(r)[1:6] for r in gold.collect()}
    assert rows == {
        "WN": (2, 46.0, 57.0, 0.0, 1000.0),
        "AA": (2, None, None, 2.0, 500.0),
        None: (1, 5.0, 6.0, 0.0, 7.0),
    }


def test_spread(silver):
    gold = carrier_delay_spread(silver, "2026-03-02 00:00:00")
    assert gold.dtypes == list(CARRIER_DELAY_SPREAD)
    rows = {r.carrier: r for r in gold.collect()}
    assert rows["WN"].std_dep_delay == pytest.approx(statistics.stdev([82, 10]))
    assert rows["WN"].std_arr_delay is None and rows["AA"].std_dep_delay is None
    assert rows[None].avg_arr_delay == 6.0


def test_daily_counts_and_totals(spark):
    df = spark.createDataFrame([(i, date(2026, 3, 2)) for i in range(100)], "event_id long, event_date date")
    gold = daily_event_counts(df)
    assert gold.dtypes == list(DAILY_EVENT_COUNTS)
    assert [(r.event_date, r.event_count) for r in gold.collect()] == [(date(2026, 3, 2), 100)]
    assert total(gold, "event_count", "t").first().t == 100
    assert row_count(df).first().n == 100
    assert rows_per_key(df, "event_date").first().row_count == 100


def test_distinct_keys_skips_null_like_sql(silver):
    assert distinct_keys(silver, "carrier", "n").first().n == 2


def test_top_has_a_fixed_order_on_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), ("d", None)], "k string, v int")
    assert [r.k for r in top_by(df, "v", "k", 3).collect()] == ["c", "a", "b"]
    assert [r.k for r in top_by(df, "v", "k", 10).collect()] == ["c", "a", "b", "d"]
    assert "TakeOrderedAndProject" in top_by(df, "v", "k", 3)._jdf.queryExecution().toString()


def brute_rank(values):
    """1 + how many rows are strictly greater; NULLs come after all values and tie."""
    known = [v for v in values if v is not None]
    return [
        1 + (len(known) if v is None else sum(other > v for other in known)) for v in values
    ]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(-5, 5), st.integers(-1000, 1000)), max_size=60),
    st.sampled_from([2, 3, 64]),
)
def test_rank_equals_brute_force(spark, values, ranges):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v int")
    found = {r.id: r.r for r in rank_by(df, {"v": "r"}, ranges).collect()}
    assert found == dict(enumerate(brute_rank(values)))


def test_rank_with_a_third_of_the_rows_on_one_value(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.col("id").cast("double")).alias("v")
    )
    values = [500.0 if i % 3 == 0 else float(i) for i in range(3000)]
    order = sorted(values, reverse=True)
    first = {v: i + 1 for i, v in reversed(list(enumerate(order)))}
    found = {r.id: r.r for r in rank_by(df, {"v": "r"}, 16).collect()}
    assert found == {i: first[v] for i, v in enumerate(values)}


def test_two_ranks_at_once_keep_all_rows(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, None), ("c", 2, 7.5)], "k string, n int, d double")
    rows = {r.k: (r.x, r.y) for r in rank_by(df, {"n": "x", "d": "y"}).collect()}
    assert rows == {"a": (2, 2), "b": (2, 3), "c": (1, 1)}


def test_rank_never_puts_all_rows_in_one_window_partition(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS v")
    plan = rank_by(df, {"v": "r"})._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    # One window is over the counted ranges only, the other is split by range.
    assert sum("[_range" in w.split("windowspecdefinition(")[1] for w in windows) == 2
    assert any("sum(_size" in w for w in windows)


def test_profile_against_brute_force(spark):
    rows = [(1, "a", None), (2, "a", 1.5), (2, None, 1.5), (None, "b", 2.5)]
    df = spark.createDataFrame(rows, "i int, s string, `odd name` double")
    for distinct in ("exact", "approx"):
        found = [tuple(r) for r in profile(df, distinct).collect()]
        wanted = [
            (
                name,
                kind,
                4,
                sum(r[i] is not None for r in rows),
                len({r[i] for r in rows if r[i] is not None}),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
        assert found == wanted
    assert profile(df, None).columns == ["column_name", "data_type", "row_count", "non_null_count"]
    assert [tuple(r) for r in describe(df).collect()] == df.dtypes
