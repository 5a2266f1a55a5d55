from datetime import date

import pytest

from strata.contracts import FLIGHTS_SILVER, check_schema
from strata.errors import ReconciliationFailed, SchemaMismatch
from strata.operators import lineage, rank_by, reconcile, require_reconciled, top_by
from strata.plans import EVENTS, EVENTS_GOLD, FLIGHTS, FLIGHTS_GOLD, run_events, run_flights
from strata.plans.events import build_events_gold, build_events_silver, land_events
from strata.plans.flights import flights_report
from strata.sinks import land_day
from strata.sources import generate_events, read_layer

AT = "2026-03-02 00:00:00"


def test_flights_end_to_end(spark, lake, flights_csv):
    results = run_flights(spark, lake, flights_csv, at=AT)
    assert {layer: r.rows for layer, r in results.items()} == {"bronze": 3, "silver": 3, "gold": 3}
    assert results["silver"].metrics == {"rejects": 0}
    silver = check_schema(read_layer(spark, lake.path(FLIGHTS.at("silver"))), FLIGHTS_SILVER)
    gold = read_layer(spark, lake.path(FLIGHTS_GOLD))
    rows = {r.carrier: tuple(r)[1:6] for r in gold.collect()}
    assert rows["WN"] == (1, 82.0, 57.0, 0.0, 1999.0)
    assert rows["AA"] == (1, None, None, 1.0, 569.0)
    assert tuple(flights_report(spark, lake).first()) == (3, 3, 3, 3, True)
    sources = {tuple(r)[:3] for r in lineage({"silver": silver}).collect()}
    assert sources == {("silver", "flights.csv", 3)}
    assert [r.carrier for r in top_by(gold, "flight_count", "carrier").collect()] == ["AA", "DL", "WN"]
    ranks = {r.carrier: r.delay_rank for r in rank_by(gold, {"avg_arr_delay_minutes": "delay_rank"}).collect()}
    assert ranks == {"WN": 1, "DL": 2, "AA": 3}


def test_flights_again_changes_nothing(spark, lake, flights_csv):
    first = run_flights(spark, lake, flights_csv, at=AT)
    gold = sorted(read_layer(spark, lake.path(FLIGHTS_GOLD)).collect(), key=str)
    assert run_flights(spark, lake, flights_csv, at=AT) == first
    assert sorted(read_layer(spark, lake.path(FLIGHTS_GOLD)).collect(), key=str) == gold


def test_events_end_to_end(spark, lake):
    results = run_events(spark, lake, generate_events(spark, 100, "2026-03-02", AT), AT)
    assert [r.rows for r in results.values()] == [100, 100, 1]
    gold = read_layer(spark, lake.path(EVENTS_GOLD)).first()
    assert (gold.event_date, gold.event_count) == (date(2026, 3, 2), 100)


def test_new_day_is_added_without_touching_the_old(spark, lake):
    land_events(generate_events(spark, 100, "2026-03-02", AT), lake)
    build_events_silver(spark, lake, AT)
    land_day(generate_events(spark, 40, "2026-03-03", AT), lake.path(EVENTS), "2026-03-03")
    added = build_events_silver(spark, lake, AT, days=["2026-03-03"])
    assert added.rows == 40
    silver = read_layer(spark, added.path).where("event_date = date'2026-03-02'")
    assert silver.count() == 100
    assert build_events_silver(spark, lake, AT).rows == 140
    build_events_gold(spark, lake, AT)
    counts = read_layer(spark, lake.path(EVENTS_GOLD)).orderBy("event_date").collect()
    assert [r.event_count for r in counts] == [100, 40]


def test_bad_date_stays_as_a_row(spark, lake):
    events = generate_events(spark, 3, "soon", AT)
    land_events(events, lake)
    result = build_events_silver(spark, lake, AT)
    assert (result.rows, result.metrics) == (3, {"rejects": 3})
    assert build_events_gold(spark, lake, AT).rows == 1
    gold = read_layer(spark, lake.path(EVENTS_GOLD)).first()
    assert (gold.event_date, gold.event_count) == (None, 3)


def test_landing_refuses_other_columns(spark, lake):
    with pytest.raises(SchemaMismatch):
        land_events(spark.range(3), lake)


def test_lost_rows_stop_the_flow(spark):
    three = spark.range(3)
    gold = spark.createDataFrame([("a", 2)], "k string, n long")
    report = reconcile(three, three, gold, "n")
    assert tuple(report.first()) == (3, 3, 2, 1, False)
    with pytest.raises(ReconciliationFailed, match="'gold_total': 2"):
        require_reconciled(report)
    empty = spark.createDataFrame([], "k string, n long")
    nothing = reconcile(spark.range(0), spark.range(0), empty, "n").first()
    assert tuple(nothing) == (0, 0, 0, 0, False)
