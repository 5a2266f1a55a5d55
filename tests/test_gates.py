"""Streams that keep what is late or does not fit, and topic offsets after a lost producer."""

import shutil
from datetime import datetime, timedelta

import pytest

from strata.contracts import Column, Conform
from strata.errors import SchemaMismatch
from strata.sinks import messages, produce, topics, write_layer
from strata.sources import read_layer, read_topic
from strata.streaming import (
    corrected_throughput,
    reject_report,
    run_available,
    run_throughput,
    split_batch,
    stream_files,
    to_silver_or_quarantine,
)

EVENT = "event_id long, ts timestamp"
COLUMNS = [Column("event_id", "bigint"), Column("ts", "timestamp")]


def test_late_events_become_corrections(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    start = datetime(2026, 3, 1)
    hours = [0, 5, 30, 200, 1, 2, 31, 190, 201, 400, 3, 3]
    rows = [(i, start + timedelta(hours=h)) for i, h in enumerate(hours)] + [(99, None)]

    def run(part):
        write_layer(spark.createDataFrame(part, EVENT), source, mode="append")
        run_throughput(stream_files(spark, source, COLUMNS), target, str(tmp_path / "c"))
        out = corrected_throughput(read_layer(spark, target)).collect()
        return {r.event_date.day: (r.event_count, r.late_count) for r in out}

    assert run(rows[:4]) == {1: (2, 0), 2: (1, 0)}
    assert run(rows[4:10]) == {1: (4, 2), 2: (2, 1), 8: (1, 0), 9: (2, 0)}
    assert run(rows[10:]) == {1: (6, 4), 2: (2, 1), 8: (1, 0), 9: (2, 0)}
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == plain


FIELDS = [Conform("id", "bigint", "order_id"), Conform("amount", "double", "amount"), Conform("note", "string", "note")]
TEXT = [Column("id", "string"), Column("amount", "string"), Column("note", "string")]
ROWS = [("1", "1.5", "a"), ("x", "2", None), ("3", "n/a", "c"), ("y", "z", "d"), (None, None, None)]


def gate(spark, tmp_path):
    places = [str(tmp_path / p) for p in ("silver", "quarantine", "checkpoint")]
    bronze = stream_files(spark, str(tmp_path / "in"), TEXT, 1)
    run_available(to_silver_or_quarantine(bronze, FIELDS, *places))
    silver = [tuple(r)[:3] for r in read_layer(spark, places[0]).collect()]
    aside = [(r.id, r.amount, r.note, tuple(r.faults)) for r in read_layer(spark, places[1]).collect()]
    return sorted(silver, key=str), sorted(aside)


def arrive(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "id string, amount string, note string").coalesce(1)
    write_layer(df, str(tmp_path / "in"), mode="append")


def test_rejects_are_kept_and_nothing_is_lost(spark, tmp_path):
    arrive(spark, tmp_path, ROWS)
    silver, aside = gate(spark, tmp_path)
    assert silver == [(1, 1.5, "a"), (None, None, None)]
    assert aside == [
        ("3", "n/a", "c", ("amount",)),
        ("x", "2", None, ("order_id",)),
        ("y", "z", "d", ("order_id", "amount")),
    ]
    assert gate(spark, tmp_path) == (silver, aside)
    report = reject_report(read_layer(spark, str(tmp_path / "quarantine")))
    assert {tuple(r) for r in report.collect()} == {("order_id", 2), ("amount", 2)}


def test_a_batch_that_was_lost_replaces_itself(spark, tmp_path):
    arrive(spark, tmp_path, ROWS)
    wanted = gate(spark, tmp_path)
    commits = tmp_path / "checkpoint" / "commits"
    for f in [*commits.glob("0"), *commits.glob(".0.crc")]:
        f.unlink()
    shutil.rmtree(tmp_path / "quarantine")
    assert gate(spark, tmp_path) == wanted
    arrive(spark, tmp_path, [("7", "7", "late")])
    silver, aside = gate(spark, tmp_path)
    assert len(silver) == 3 and aside == wanted[1]


def test_a_column_of_that_name_is_refused(spark, tmp_path):
    df = spark.createDataFrame([("1", "1", "n", "f")], "id string, amount string, note string, faults string")
    with pytest.raises(SchemaMismatch):
        split_batch(df, 0, FIELDS, str(tmp_path / "a"), str(tmp_path / "b"))


def offsets(spark, lake):
    return sorted(r.offset for r in read_topic(spark, lake, "t").collect())


def test_offsets_go_on_after_a_lost_producer(spark, lake, monkeypatch):
    produce(spark, lake, "t", 3)

    def lost(*_):
        raise RuntimeError("lost before the note")

    with monkeypatch.context() as patch:
        patch.setattr(topics, "_keep_ends", lost)
        with pytest.raises(RuntimeError):
            produce(spark, lake, "t", 3)
    produce(spark, lake, "t", 3)
    topics.append_rows(messages(spark, "t", 2).withColumnRenamed("offset", "nth"), lake, "t", "nth")
    assert offsets(spark, lake) == list(range(11))


def test_a_half_written_note_is_not_believed(spark, lake, tmp_path):
    produce(spark, lake, "t", 3)
    note = tmp_path / "lake" / "_topic_ends" / "t"
    (note / "_SUCCESS").unlink()
    for f in note.glob("part-*"):
        f.unlink()
    produce(spark, lake, "t", 2)
    assert offsets(spark, lake) == list(range(5))
