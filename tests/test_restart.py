"""Raw landing with counted faults, steps that are not repeated, row checks in the flow."""

import pytest
from pyspark.sql import functions as F

from strata.contracts import FLIGHTS_RAW, check_schema
from strata.errors import NoSharedFolder, ReconciliationFailed
from strata.plans import FLIGHTS, FLIGHTS_GOLD, flights, run_flights
from strata.plans.flights import check_flights
from strata.plans.ledger import Ledger, listing_digest
from strata.sinks import JobResult, write_layer
from strata.sources import read_layer
from strata.workspace import scratch_folder

AT = "2026-03-02 00:00:00"
HEADER = "OP_UNIQUE_CARRIER,ORIGIN,DEST,DEP_DELAY_NEW,ARR_DELAY_NEW,CANCELLED,DISTANCE"


def staging(tmp_path, name, *lines, header=HEADER):
    folder = tmp_path / "staging"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def test_text_is_kept_and_counted(spark, lake, tmp_path):
    source = staging(
        tmp_path, "a.csv", "WN,PHX,BWI,82.0,n/a,0.0,1999.0", "DL,ATL,LIT,late,1.0,0.0,453.0", "AA,ABQ"
    )
    results = run_flights(spark, lake, source, at=AT, check_rows=True)
    assert results["bronze"].metrics == {"malformed": 1}
    assert results["silver"].metrics == {"rejects": 2}
    bronze = check_schema(read_layer(spark, lake.path(FLIGHTS)), FLIGHTS_RAW)
    assert {(r.dep_delay_new, r.arr_delay_new) for r in bronze.collect()} == {
        ("82.0", "n/a"),
        ("late", "1.0"),
        (None, None),
    }
    gold = {r.carrier: r.avg_dep_delay_minutes for r in read_layer(spark, lake.path(FLIGHTS_GOLD)).collect()}
    assert gold == {"WN": 82.0, "DL": None, "AA": None}


def test_columns_go_by_name(spark, lake, tmp_path):
    header = "REMARK,DISTANCE,CANCELLED,ARR_DELAY_NEW,DEP_DELAY_NEW,DEST,ORIGIN,OP_UNIQUE_CARRIER"
    source = staging(tmp_path, "a.csv", "x,453.0,0.0,1.0,9.0,LIT,ATL,DL", header=header)
    run_flights(spark, lake, source, at=AT)
    row = read_layer(spark, lake.path(FLIGHTS.at("silver"))).first()
    assert (row.carrier, row.dep_delay_minutes, row.distance_miles) == ("DL", 9.0, 453.0)


def times(lake, tmp_path, layer):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "lake" / layer).rglob("part-*")}


def test_a_flow_that_failed_in_gold_goes_on_there(spark, lake, tmp_path, monkeypatch):
    source = staging(tmp_path, "a.csv", "DL,ATL,LIT,9.0,1.0,0.0,453.0")

    def lost(*_):
        raise RuntimeError("lost in gold")

    with monkeypatch.context() as patch:
        patch.setattr(flights, "build_flights_gold", lost)
        with pytest.raises(RuntimeError):
            run_flights(spark, lake, source, at=AT, resume=True)
    before = {layer: times(lake, tmp_path, layer) for layer in ("bronze", "silver")}
    assert all(before.values())
    first = run_flights(spark, lake, source, at=AT, resume=True)
    assert {layer: times(lake, tmp_path, layer) for layer in before} == before
    gold = times(lake, tmp_path, "gold")
    assert run_flights(spark, lake, source, at=AT, resume=True) == first
    assert times(lake, tmp_path, "gold") == gold

    staging(tmp_path, "b.csv", "WN,PHX,BWI,82.0,57.0,0.0,1999.0")
    again = run_flights(spark, lake, source, at=AT, resume=True)
    assert [r.rows for r in again.values()] == [2, 2, 2]
    assert times(lake, tmp_path, "bronze") != before["bronze"]


def test_settings_and_missing_output_run_a_step_again(spark, lake, tmp_path):
    runs = []

    def action(name):
        def run():
            runs.append(name)
            return write_layer(spark.range(3), f"{tmp_path}/{name}", metrics={"top": F.max("id")})

        return run

    def flow(setting):
        ledger = Ledger(spark, lake, "demo")
        results = [ledger.step(n, [setting] if n == "one" else [], action(n)) for n in ("one", "two")]
        assert all(r == JobResult(f"{tmp_path}/{n}", 3, {"top": 2}) for n, r in zip(("one", "two"), results))
        return ledger.skipped

    assert flow("a") == [] and flow("a") == ["one", "two"]
    assert flow("b") == []
    (tmp_path / "two" / "_SUCCESS").unlink()
    assert flow("b") == ["one"]
    assert runs == ["one", "two", "one", "two", "two"]


def test_listing_digest_follows_names_and_content(spark, tmp_path):
    source = staging(tmp_path, "a.csv", "1")
    first = listing_digest(spark, source)
    assert listing_digest(spark, source) == first
    staging(tmp_path, "b.csv", "1")
    assert listing_digest(spark, source) != first


def test_a_damaged_silver_is_found(spark, lake, tmp_path):
    lines = [f"C{i},A,B,{i}.0,1.0,0.0,10.0" for i in range(5)]
    run_flights(spark, lake, staging(tmp_path, "a.csv", *lines), at=AT)
    check_flights(spark, lake)
    path = lake.path(FLIGHTS.at("silver"))
    rows = read_layer(spark, path).collect()
    damaged = spark.createDataFrame([*rows[1:], rows[1]], read_layer(spark, path).schema)
    write_layer(damaged, path)
    with pytest.raises(ReconciliationFailed, match="rows differ"):
        check_flights(spark, lake)


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        sparkContext = spark.sparkContext

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    class Cluster(Session):
        class sparkContext:
            master = "yarn"
            _jvm, _jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

    with pytest.raises(NoSharedFolder):
        scratch_folder(Cluster, "x")
    Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(NoSharedFolder):
        scratch_folder(Cluster, "x")
