from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from strata.contracts import EVENTS_BRONZE, EVENTS_SILVER, check_schema
from strata.lake import DatasetRef
from strata.operators import conform_events
from strata.sinks import produce, write_layer
from strata.sources import read_layer, read_topic
from strata.streaming import (
    daily_throughput,
    run_available,
    stream_files,
    stream_to_bronze,
    stream_to_silver,
    to_parquet,
)


def test_topic_to_bronze_once_and_only_new_messages_later(spark, lake):
    target, checkpoint = lake.path(DatasetRef("bronze", "demo", "topic")), lake.checkpoint_path("q")

    def run():
        bronze = stream_to_bronze(read_topic(spark, lake, "t", stream=True), "t")
        run_available(to_parquet(bronze, target, checkpoint))
        return read_layer(spark, target)

    produce(spark, lake, "t", 10)
    assert run().count() == 10
    assert run().count() == 10
    produce(spark, lake, "t", 3)
    bronze = run()
    assert bronze.count() == 13
    assert [r.offset for r in bronze.orderBy("offset").collect()] == list(range(13))
    assert {r.source_file for r in bronze.collect()} == {"t"}


def test_bronze_stream_names_the_file_of_each_row(spark, lake, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_layer(spark.range(4).selectExpr("id AS event_id", "current_timestamp() AS ts", "1.0D AS value", "'2026-03-02' AS dt"), source)
    bronze = stream_to_bronze(stream_files(spark, source, EVENTS_BRONZE))
    run_available(to_parquet(bronze, target, str(tmp_path / "c")))
    names = {r.source_file for r in read_layer(spark, target).collect()}
    assert names and all(n.endswith(".parquet") for n in names)


def _events(spark, path, first, n, hours):
    start = datetime(2026, 3, 1)
    rows = [
        (first + i, start + timedelta(hours=hours * i), 1.0, str((start + timedelta(hours=hours * i)).date()))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, value double, dt string")
    write_layer(df, path, mode="append")
    return df


def test_stream_conform_equals_batch_conform(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = _events(spark, source, 0, 20, 5)
    at = "2026-03-02 00:00:00"
    stream = stream_to_silver(stream_files(spark, source, EVENTS_BRONZE, 1), at)
    run_available(to_parquet(stream, target, str(tmp_path / "c"), ["event_date"]))
    found = check_schema(read_layer(spark, target), EVENTS_SILVER)
    wanted = conform_events(df, at)
    assert sorted(found.select(wanted.columns).collect()) == sorted(wanted.collect())


def test_throughput_emits_closed_days_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        counts = daily_throughput(stream_files(spark, source, EVENTS_BRONZE))
        run_available(to_parquet(counts, target, str(tmp_path / "c")))
        rows = read_layer(spark, target).orderBy("event_date").collect()
        return [(r.event_date, r.event_count) for r in rows]

    # One event every 6 hours over 5 days: the last at March 5, 18:00, so the watermark is
    # March 4, 18:00 and March 1 to 3 are closed.
    _events(spark, source, 0, 20, 6)
    closed = [(date(2026, 3, d), 4) for d in (1, 2, 3)]
    assert run() == closed
    assert run() == closed


def test_throughput_in_batch_is_every_day(spark):
    df = spark.range(48).select(
        (F.lit("2026-03-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts")
    )
    rows = daily_throughput(df).orderBy("event_date").collect()
    assert [(r.event_date, r.event_count) for r in rows] == [(date(2026, 3, 1), 24), (date(2026, 3, 2), 24)]
    assert rows[0].window_end == rows[1].window_start
