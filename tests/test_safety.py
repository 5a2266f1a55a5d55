"""Nothing is lost silently: late rows, foreign rows, partition text, overwrites, rebuilt days."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.catalog import register_table
from strata.errors import ForeignRows, LateRows, SelfOverwrite
from strata.lake import DatasetRef
from strata.operators import rank_by
from strata.plans import build_all, run_flights
from strata.plans.events import EVENTS, build_events_silver, land_events
from strata.sinks import land_day, publish, write_layer
from strata.sinks.topics import append_rows, log_ends, produce
from strata.sources import read_partition, read_partitioned, read_topic
from strata.streaming import daily_throughput, open_windows, run_available, stream_files, to_parquet
from strata.contracts import Column

TIMED = (Column("ts", "timestamp"),)


def timed(spark, tmp_path, days):
    """One file per day, read in the order given."""
    path = str(tmp_path / "events")
    for day in days:
        rows = spark.range(24).select(
            F.expr(f"TIMESTAMP '2026-03-{day:02d} 00:00:00' + make_interval(0, 0, 0, 0, id)").alias("ts")
        )
        rows.coalesce(1).write.mode("append").parquet(path)
    return path


def test_files_in_disorder(spark, lake, tmp_path):
    path = timed(spark, tmp_path, [10, 11, 1])

    def run(name, limit, **options):
        stream = daily_throughput(stream_files(spark, path, TIMED, limit))
        target = lake.path(DatasetRef("gold", "demo", name))
        run_available(to_parquet(stream, target, lake.checkpoint_path(name)), **options)
        return {r.event_date.day: r.event_count for r in spark.read.parquet(target).collect()}

    assert run("whole", None) == {1: 24}
    with pytest.raises(LateRows):
        run("split", 1)
    run("allowed", 1, allow_late=True)
    rows = spark.read.parquet(path)
    assert {r.event_date.day: r.event_count for r in open_windows(rows).collect()} == {10: 24, 11: 24}


def days_of(spark, *rows):
    return spark.createDataFrame(
        [(i, None, 1.0, dt) for i, dt in enumerate(rows)],
        "event_id bigint, ts timestamp, value double, dt string",
    )


def test_landing_refuses_or_counts_other_days(spark, tmp_path):
    rows = days_of(spark, "2026-03-01", "2026-03-01", "2026-03-02", None)
    with pytest.raises(ForeignRows):
        land_day(rows, str(tmp_path), "2026-03-01")
    assert not list(tmp_path.iterdir())
    result = land_day(rows, str(tmp_path), "2026-03-01", skip_others=True)
    assert (result.rows, result.metrics["others"]) == (2, 2)


def test_rebuilding_days_replaces_exactly_these(spark, lake):
    silver = lake.path(EVENTS.at("silver"))
    counts = lambda: {
        str(r.event_date): r.n
        for r in spark.read.parquet(silver).groupBy("event_date").agg(F.count("*").alias("n")).collect()
    }
    land_events(days_of(spark, *["soon"] * 3, *["later"] * 4, *["2026-03-01"] * 5, "2026-03-02"), lake)
    build_events_silver(spark, lake)
    whole = {"None": 7, "2026-03-01": 5, "2026-03-02": 1}
    assert counts() == whole
    build_events_silver(spark, lake, days=["soon"])
    assert counts() == whole
    land_day(days_of(spark).where("false"), lake.path(EVENTS), "2026-03-01")
    build_events_silver(spark, lake, days=["2026-03-01"])
    assert counts() == {"None": 7, "2026-03-02": 1}


def test_partition_keys_keep_their_text(spark, tmp_path):
    path = str(tmp_path / "hours")
    spark.range(24).select("id", F.lpad(F.col("id").cast("string"), 2, "0").alias("hour")).write.partitionBy(
        "hour"
    ).parquet(path)
    found = read_partitioned(spark, path, {"hour": "string"})
    assert {r.hour for r in found.collect()} == {f"{h:02d}" for h in range(24)}
    seven = read_partition(spark, path, "hour", "07")
    assert [r.id for r in seven.collect()] == [7]
    assert "PartitionFilters: [isnotnull(hour" in seven._jdf.queryExecution().executedPlan().toString()


def test_overwriting_what_the_frame_reads_is_refused(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.range(5).write.parquet(path)
    with pytest.raises(SelfOverwrite):
        write_layer(spark.read.parquet(path).where("id > 1"), path)
    assert spark.read.parquet(path).count() == 5


def test_rebuild_after_registration(spark, lake, flights_csv):
    for _ in range(2):
        run_flights(spark, lake, flights_csv)
        register_table(spark, lake, DatasetRef("silver", "aviation", "flights"))
        built = build_all(spark, lake, "aviation")
        assert all(r.rows == 3 for r in built.values())
    run_flights(spark, lake, flights_csv)
    assert build_all(spark, lake, "aviation")["carrier_summary"].rows == 3


def test_table_over_a_root_shows_its_partitions(spark, lake):
    land_events(days_of(spark, "2026-03-01", "2026-03-02"), lake)
    name = register_table(spark, lake, EVENTS)
    assert spark.table(name).count() == 2


def test_rank_on_text(spark):
    words = ["b", "a", "é", "zz", None, "a", "Z"] * 30
    df = spark.createDataFrame([(w,) for w in words], "w string")
    found = rank_by(df, {"w": "r"}, ranges=3)
    df.createOrReplaceTempView("rank_words")
    wanted = spark.sql("SELECT w, rank() OVER (ORDER BY w DESC NULLS LAST) AS r FROM rank_words")
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
    spark.catalog.dropTempView("rank_words")


def test_offsets_go_on_without_reading_the_log(spark, lake):
    produce(spark, lake, "t", 5, partitions=2)
    produce(spark, lake, "t", 4, partitions=2)
    assert log_ends(spark, lake, "t") == {0: 5, 1: 4}
    rows = read_topic(spark, lake, "t")
    assert rows.select("partition", "offset").distinct().count() == 9
    more = spark.range(3).select(
        F.lit(None).cast("string").alias("key"), F.lit("v").alias("value"),
        F.current_timestamp().alias("timestamp"), F.col("id").alias("nth"),
    )
    append_rows(more, lake, "t", "nth")
    assert log_ends(spark, lake, "t") == {0: 8, 1: 4}
    publish(rows.where("false"), lake, "t")
    assert log_ends(spark, lake, "t") == {0: 8, 1: 4}
