import os
import shutil
from datetime import date

import pytest
from pyspark.errors import AnalysisException

from strata.catalog import (
    drop_table,
    ensure_layer,
    list_tables,
    register_partitioned_table,
    register_table,
    run_script,
    run_sql,
    sample,
    sync_partitions,
)
from strata.contracts import CARRIER_DELAY_SPREAD, EVENTS_SILVER, ddl
from strata.errors import ModelNotFound
from strata.lake import DatasetRef
from strata.operators import conform_events, conform_flights
from strata.plans import build_all, build_model, list_models
from strata.plans.events import EVENTS
from strata.plans.flights import FLIGHTS, build_flights_silver, ingest_flights
from strata.plans.models import model_args, model_text
from strata.sinks import insert_select, land_day, write_layer
from strata.sources import generate_events, read_layer


def test_bronze_day_becomes_a_table_and_dropping_it_leaves_the_files(spark, lake):
    landed = land_day(generate_events(spark, 100, "2026-03-02"), lake.path(EVENTS), "2026-03-02")
    land_day(generate_events(spark, 7, "2026-03-03"), lake.path(EVENTS), "2026-03-03")
    name = register_table(spark, lake, EVENTS, day="2026-03-02")
    assert list_tables(spark, lake, "bronze") == ["demo_sample_events"]
    assert spark.table(name).count() == 100
    assert dict(spark.table(name).dtypes) == {
        "event_id": "bigint",
        "ts": "timestamp",
        "value": "double",
        "dt": "string",
    }
    first = spark.table(name).orderBy("event_id").limit(5).collect()
    assert [(r.event_id, r.dt) for r in first] == [(i, "2026-03-02") for i in range(5)]
    assert sample(spark, lake, EVENTS).count() == 5
    register_table(spark, lake, EVENTS, day="2026-03-03")
    assert spark.table(name).count() == 7
    with pytest.raises(AnalysisException):
        register_table(spark, lake, EVENTS, day="2026-03-03", drop_first=False)
    drop_table(spark, lake, EVENTS)
    drop_table(spark, lake, EVENTS)
    assert list_tables(spark, lake, "bronze") == []
    assert read_layer(spark, landed.path).count() == 100


def test_partition_sync_is_full(spark, lake):
    ref = EVENTS.at("silver")
    path = lake.path(ref)
    first = conform_events(generate_events(spark, 100, "2026-03-02"))
    write_layer(first, path, partition_by=["event_date"])
    name = register_partitioned_table(
        spark, lake, ref, ["event_date"], EVENTS_SILVER, sync=False
    )
    assert spark.table(name).count() == 0
    sync_partitions(spark, lake, ref)
    assert spark.table(name).count() == 100
    counts = spark.table(name).groupBy("event_date").count().collect()
    assert [tuple(r) for r in counts] == [(date(2026, 3, 2), 100)]
    assert dict(spark.table(name).dtypes)["event_date"] == "date"

    write_layer(
        conform_events(generate_events(spark, 5, "2026-03-03")),
        path,
        partition_by=["event_date"],
        dynamic=True,
    )
    shutil.rmtree(os.path.join(path, "event_date=2026-03-02"))
    sync_partitions(spark, lake, ref)
    assert [tuple(r) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == [
        ("event_date=2026-03-03",)
    ]
    assert spark.table(name).count() == 5


def test_partitioned_table_takes_columns_from_files(spark, lake):
    ref = DatasetRef("silver", "demo", "other")
    df = spark.createDataFrame([(1, "x", 5)], "`odd name` int, v string, k int")
    write_layer(df, lake.path(ref), partition_by=["k"])
    name = register_partitioned_table(spark, lake, ref, ["k"])
    assert tuple(spark.table(name).first()) == (1, "x", 5)


def test_sql_passthrough_takes_joins_windows_sets_and_parameters(spark):
    text = """
        WITH t AS (SELECT id, id % 3 AS k FROM range(10))
        SELECT k, sum(id) AS s, rank() OVER (ORDER BY sum(id) DESC) AS r
        FROM t WHERE id IN (SELECT id FROM t EXCEPT SELECT :skip) GROUP BY k
    """
    rows = run_sql(spark, text, {"skip": 9}).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 9, 3), (1, 12, 2), (2, 15, 1)]


def test_script_runs_statements_in_order(spark, lake, tmp_path):
    script = f"""
        CREATE SCHEMA IF NOT EXISTS {lake.schema("gold")} LOCATION '{tmp_path}/gold';
        DROP TABLE IF EXISTS {lake.schema("gold")}.t;
        CREATE TABLE {lake.schema("gold")}.t (a INT) USING parquet LOCATION '{tmp_path}/t';
        INSERT OVERWRITE TABLE {lake.schema("gold")}.t VALUES (1), (2);
        SELECT sum(a) AS s FROM {lake.schema("gold")}.t;
    """
    assert run_script(spark, script).first().s == 3
    assert run_script(spark, script).first().s == 3


@pytest.fixture
def built(spark, lake, flights_csv):
    ingest_flights(spark, lake, flights_csv)
    build_flights_silver(spark, lake)
    register_table(spark, lake, FLIGHTS.at("silver"))
    return lake


def test_models_are_listed_by_name():
    assert list_models("aviation") == ["carrier_delay_spread", "carrier_summary"]
    assert list_models("demo") == ["daily_event_counts"]
    assert list_models("nothing_here") == []


def test_build_twice_leaves_rows_once(spark, built):
    for _ in range(2):
        result = build_model(spark, built, "aviation", "carrier_delay_spread")
    table = spark.table(built.table(DatasetRef("gold", "aviation", "carrier_delay_spread")))
    assert result.rows == table.count() == 3
    rows = {r.carrier: r for r in table.collect()}
    assert rows["AA"].avg_dep_delay is None and rows["WN"].avg_arr_delay == 57.0
    assert all(r.std_arr_delay is None for r in rows.values())
    assert dict(table.dtypes)["built_at"] == "timestamp_ntz"


def test_a_script_and_its_insert_run_twice_leave_rows_once(spark, built):
    ref = DatasetRef("gold", "aviation", "carrier_delay_spread")
    name, select = built.table(ref), model_text(ref.project, ref.name)
    ensure_layer(spark, built, "gold")
    for _ in range(2):
        run_script(
            spark,
            f"""
            DROP TABLE IF EXISTS {name};
            CREATE TABLE {name} ({ddl(CARRIER_DELAY_SPREAD)})
            USING parquet LOCATION '{built.path(ref)}';
            """,
        )
        insert_select(spark, name, select, model_args(built, "2026-03-02 00:00:00"))
    assert spark.table(name).count() == 3


def test_build_all_and_unknown_model(spark, built):
    results = build_all(spark, built, "aviation", "2026-03-02 00:00:00")
    assert {k: v.rows for k, v in results.items()} == {
        "carrier_delay_spread": 3,
        "carrier_summary": 3,
    }
    with pytest.raises(ModelNotFound) as caught:
        build_model(spark, built, "aviation", "no_such_model")
    assert caught.value.exit_code == 2
    with pytest.warns(UserWarning, match="no gold models"):
        assert build_all(spark, built, "nothing_here") == {}


def test_sql_model_equals_the_dataframe_operator(spark, built):
    from strata.operators import carrier_summary

    at = "2026-03-02 00:00:00"
    build_model(spark, built, "aviation", "carrier_summary", at)
    table = spark.table(built.table(DatasetRef("gold", "aviation", "carrier_summary")))
    frame = carrier_summary(spark.table(built.table(FLIGHTS.at("silver"))), at)
    assert table.columns == frame.columns and table.dtypes == frame.dtypes
    assert sorted(table.collect(), key=str) == sorted(frame.collect(), key=str)


def test_own_model_folder(spark, built, tmp_path):
    folder = tmp_path / "models" / "aviation"
    folder.mkdir(parents=True)
    (folder / "routes.sql").write_text(
        "SELECT origin, dest, count(*) AS n FROM identifier(:silver || '.aviation_flights')"
        " GROUP BY origin, dest"
    )
    result = build_model(spark, built, "aviation", "routes", models=tmp_path / "models")
    assert result.rows == 3


def test_conform_is_one_projection(spark, built):
    plan = conform_flights(read_layer(spark, built.path(FLIGHTS))).select("carrier")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<op_unique_carrier:string>" in text
