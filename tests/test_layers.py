"""Layers that read-only queries share."""

from __future__ import annotations

from datetime import datetime

from strata.plans.events import EVENTS
from strata.queries.layers import conformed_events, landed_events
from strata.sources import read_layer
from strata.workspace import delete_folder

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def write_events(spark, folder, n):
    rows = [(i, datetime(2026, 3, 1 + i % 3, 12), i, "view", 1.0, None) for i in range(n)]
    frame = spark.createDataFrame(rows, EVENT)
    frame.write.mode("overwrite").parquet(f"{folder}/events.parquet")


def silver_rows(spark, lake):
    return read_layer(spark, lake.path(EVENTS.at("silver"))).count()


def test_layers_are_written_once_and_follow_their_source(spark, tmp_path):
    write_events(spark, tmp_path, 7)
    landed = landed_events(spark, str(tmp_path))
    one, other = (conformed_events(spark, str(tmp_path)) for _ in range(2))
    assert landed.root == one.root == other.root
    assert one.schema("silver") != other.schema("silver")
    assert silver_rows(spark, one) == 7

    write_events(spark, tmp_path, 8)
    after = conformed_events(spark, str(tmp_path))
    assert after.root != one.root
    assert silver_rows(spark, after) == 8


def test_a_folder_that_is_gone_is_written_anew(spark, tmp_path):
    write_events(spark, tmp_path, 5)
    before = conformed_events(spark, str(tmp_path))
    delete_folder(spark, before.root)
    after = conformed_events(spark, str(tmp_path))
    assert after.root != before.root and silver_rows(spark, after) == 5
