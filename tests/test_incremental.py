"""New files, batches, states of parts, provenance."""

import math
import os
import time

import pytest
from pyspark.sql import functions as F

from strata.contracts import Column
from strata.errors import ChangedSource, InvalidName, ReconciliationFailed, SchemaMismatch
from strata.lake import DatasetRef
from strata.operators import (
    gold_lineage,
    lineage,
    merge_provenance,
    merge_states,
    partial_states,
    provenance,
    require_lineage,
    state_deviation,
    state_mean,
    state_sum,
    trace,
)
from strata.plans import incremental
from strata.plans.incremental import (
    ingest_new,
    ingested_files,
    merged_gold,
    pending_files,
    read_states,
    update_states,
)
from strata.sinks import append_batch, committed_batches, read_batches, write_layer
from strata.sources import read_layer, read_partitioned

REF = DatasetRef("bronze", "shop", "orders")


def drop(folder, name, lines, header="ID,Amount"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def taken(spark, lake):
    rows = read_batches(spark, lake, REF).collect()
    return sorted((r.batch_id, r.id, r.amount, r.source_file) for r in rows)


def test_each_file_is_taken_once(spark, lake, tmp_path):
    source = tmp_path / "in"
    drop(source, "a.csv", ["1,10", "2,n/a"])
    first = ingest_new(spark, lake, REF, str(source))
    assert (first.rows, first.metrics["files"], first.metrics["batch"]) == (2, 1, 0)
    again = ingest_new(spark, lake, REF, str(source))
    assert (again.rows, again.metrics["files"], again.metrics["batch"]) == (0, 0, 0)
    drop(source, "b.csv", ["3,30", "4"])
    second = ingest_new(spark, lake, REF, str(source))
    assert (second.rows, second.metrics["files"], second.metrics["malformed"]) == (2, 1, 1)
    assert taken(spark, lake) == [
        (0, "1", "10", "a.csv"),
        (0, "2", "n/a", "a.csv"),
        (1, "3", "30", "b.csv"),
        (1, "4", None, "b.csv"),
    ]
    assert {r.file_path.rsplit("/", 1)[1] for r in ingested_files(spark, lake, REF).collect()} == {"a.csv", "b.csv"}


def test_only_the_new_file_is_read(spark, lake, tmp_path):
    source = tmp_path / "in"
    drop(source, "a.csv", ["1,10"])
    ingest_new(spark, lake, REF, str(source))
    drop(source, "b.csv", ["2,20"])
    asked = []

    def read(session, paths):
        asked.extend(p.rsplit("/", 1)[1] for p in paths)
        return incremental.read_csv_text(session, paths)

    ingest_new(spark, lake, REF, str(source), read=read)
    assert asked == ["b.csv"]


def test_a_lost_run_is_repeated_under_its_number(spark, lake, tmp_path, monkeypatch):
    source = tmp_path / "in"
    drop(source, "a.csv", ["1,10"])

    def lost(*_):
        raise RuntimeError("lost before the note")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "commit_batch", lost)
        with pytest.raises(RuntimeError):
            ingest_new(spark, lake, REF, str(source))
    assert committed_batches(spark, lake, REF) == []
    with pytest.raises(InvalidName):
        read_batches(spark, lake, REF)
    drop(source, "b.csv", ["2,20"])
    assert ingest_new(spark, lake, REF, str(source)).metrics["batch"] == 0
    assert taken(spark, lake) == [(0, "1", "10", "a.csv"), (0, "2", "20", "b.csv")]


def test_a_half_written_note_does_not_count(spark, lake, tmp_path):
    source = tmp_path / "in"
    drop(source, "a.csv", ["1,10"])
    ingest_new(spark, lake, REF, str(source))
    note = f"{lake.manifest_path(REF)}/batch_id=0/_SUCCESS"
    os.remove(note)
    assert committed_batches(spark, lake, REF) == []
    assert pending_files(spark, lake, REF, str(source)).count() == 1
    ingest_new(spark, lake, REF, str(source))
    assert taken(spark, lake) == [(0, "1", "10", "a.csv")]


def test_changed_files_and_other_columns_are_refused(spark, lake, tmp_path):
    source = tmp_path / "in"
    drop(source, "a.csv", ["1,10"])
    ingest_new(spark, lake, REF, str(source))
    drop(source, "b.csv", ["2,20,x"], "ID,Amount,Note")
    with pytest.raises(SchemaMismatch):
        ingest_new(spark, lake, REF, str(source))
    os.remove(source / "b.csv")
    time.sleep(0.01)
    drop(source, "a.csv", ["1,10", "2,20"])
    with pytest.raises(ChangedSource, match="a.csv"):
        ingest_new(spark, lake, REF, str(source))


def test_a_batch_run_twice_is_there_once(spark, tmp_path):
    path = str(tmp_path / "batches")
    append_batch(spark.range(5), path, 3)
    append_batch(spark.range(5), path, 3)
    append_batch(spark.range(2), path, 4)
    assert read_layer(spark, path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(3, 5), (4, 2)]
    append_batch(spark.range(0), path, 3)
    assert read_layer(spark, path).count() == 2
    with pytest.raises(InvalidName):
        append_batch(spark.range(1), path, -1)


VALUES = [None, 1.5, 1e9, 1e9 + 1, 1e9 + 2, -3.0, 1e9 + 4, 0.0]


def days(spark):
    rows = [(f"2026-03-0{1 + i % 3}", f"k{i % 2}", VALUES[i % 8]) for i in range(50)]
    rows += [("2026-03-01", None, None), ("2026-03-02", "lonely", 7.0), ("2026-03-04", "none", None)]
    return spark.createDataFrame(rows, "day string, k string, v double")


def metrics(df):
    rows = df.select("k", "row_count", state_mean("v"), state_sum("v"), state_deviation("v")).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for k, values in wanted.items():
        for a, b in zip(found[k], values, strict=True):
            assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-6)), (k, a, b)


def direct(df):
    rows = df.groupBy("k").agg(F.count(F.lit(1)), F.avg("v"), F.sum("v"), F.stddev_samp("v")).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def test_merged_states_equal_one_aggregate(spark):
    df = days(spark)
    merged = merge_states(partial_states(df, ["day", "k"], ["v"]), ["k"], ["v"])
    same(metrics(merged), direct(df))
    twice = merge_states(merged.withColumn("part", F.lit(1)), ["k"], ["v"])
    same(metrics(twice), direct(df))
    total = merge_states(partial_states(df, ["day"], ["v"]), [], ["v"]).first()
    assert total.row_count == df.count()
    assert merge_states(partial_states(df.limit(0), ["day"], ["v"]), [], ["v"]).first().row_count == 0


def test_only_changed_days_are_read(spark, tmp_path):
    silver, states = str(tmp_path / "silver"), str(tmp_path / "states")
    df = days(spark)
    write_layer(df, silver, partition_by=["day"])

    def stored():
        return read_partitioned(spark, silver, {"day": "string"})

    keys = [Column("k", "string")]
    update_states(stored(), states, "day", ["k"], ["v"])
    same(metrics(merged_gold(spark, states, "day", keys, ["v"])), direct(df))
    changed = spark.createDataFrame([("2026-03-02", "k0", 5.0), ("2026-03-02", "new", 6.0)], df.schema)
    write_layer(changed, silver, partition_by=["day"], dynamic=True)
    untouched = {p: p.stat().st_mtime_ns for p in tmp_path.glob("states/day=2026-03-0[134]/*")}
    known = stored()
    for other in tmp_path.glob("silver/day=2026-03-0[134]/*.parquet"):
        other.write_bytes(b"not to be opened")
    update_states(known, states, "day", ["k"], ["v"], ["2026-03-02"])
    now = df.where("day <> '2026-03-02'").unionByName(changed)
    same(metrics(merged_gold(spark, states, "day", keys, ["v"])), direct(now))
    assert untouched == {p: p.stat().st_mtime_ns for p in tmp_path.glob("states/day=2026-03-0[134]/*")}


def test_a_day_without_rows_loses_its_states(spark, tmp_path):
    states = str(tmp_path / "states")
    df = days(spark)
    update_states(df, states, "day", ["k"], ["v"])
    left = df.where("day <> '2026-03-04'")
    update_states(left, states, "day", ["k"], ["v"], ["2026-03-04", "2026-03-09"])
    kept = read_states(spark, states, "day", [Column("k", "string")], ["v"])
    assert {r.day for r in kept.select("day").distinct().collect()} == {f"2026-03-0{i}" for i in (1, 2, 3)}
    assert update_states(left, states, "day", ["k"], ["v"], []).rows == 0


def test_gold_goes_back_to_its_sources(spark):
    rows = [("a", f"f{i % 3}") for i in range(9)] + [("b", "f1"), (None, "f2")]
    silver = spark.createDataFrame(rows, "carrier string, source_file string").withColumn(
        "ingest_ts", F.lit("2026-03-02").cast("timestamp")
    )
    parts = provenance(silver, ["carrier"])
    assert {(r.carrier, r.source_file, r.row_count) for r in parts.collect()} == {
        ("a", "f0", 3),
        ("a", "f1", 3),
        ("a", "f2", 3),
        ("b", "f1", 1),
        (None, "f2", 1),
    }
    again = merge_provenance(parts.unionByName(parts), ["carrier"])
    assert sorted(r.row_count for r in again.collect()) == [2, 2, 6, 6, 6]
    gold = silver.groupBy("carrier").agg(F.count(F.lit(1)).alias("flight_count"))
    traced = trace(gold, parts, ["carrier"])
    assert {(r.carrier, r.flight_count, r.source_file) for r in traced.collect() if r.carrier != "a"} == {
        ("b", 1, "f1"),
        (None, 1, "f2"),
    }
    assert traced.columns.count("carrier") == 1
    report = lineage({"silver": silver}).unionByName(gold_lineage(parts))
    require_lineage(report)
    short = lineage({"silver": silver}).unionByName(gold_lineage(parts.where("carrier = 'a'")))
    with pytest.raises(ReconciliationFailed, match="f1|f2"):
        require_lineage(short)
