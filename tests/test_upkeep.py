"""Compaction, mergeable profiles, schema drift, and smaller pieces."""

import pytest
from pyspark.sql import functions as F

from strata.errors import ReconciliationFailed, SchemaMismatch
from strata.functions import with_names
from strata.operators import (
    column_drift,
    file_schemas,
    merge_profiles,
    profile_parts,
    rank_by,
    read_profile,
    require_one_schema,
    schema_versions,
)
from strata.queries import QUERIES
from strata.sinks import compact, compaction, crowded_folders, file_bins, messages, recover, write_layer
from strata.sources import consume, first_ends, kafka_options, read_layer, read_partitioned
from tests.conftest import plan_of


def small_files(spark, path, days=3, files=12):
    for k in range(files):
        rows = spark.range(20).selectExpr(
            f"id + {20 * k} AS id",
            f"CASE WHEN id % {days} = 0 THEN NULL ELSE concat('day/', id % {days}) END AS dt",
        )
        write_layer(rows.coalesce(1), path, mode="append", partition_by=["dt"], rebalance=False)
    return sorted(read(spark, path), key=str)


def read(spark, path):
    return [(r.id, r.dt) for r in read_partitioned(spark, path, {"dt": "string"}).collect()]


def counts(spark, path):
    return {r.folder.rsplit("/", 1)[1]: r["count"] for r in file_bins(spark, path).groupBy("folder").count().collect()}


def test_many_files_become_few(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = small_files(spark, path)
    assert set(counts(spark, path).values()) == {12}
    done = compact(spark, path, "dt")
    assert done == {
        "dt=__HIVE_DEFAULT_PARTITION__": (12, 1),
        "dt=day%2F1": (12, 1),
        "dt=day%2F2": (12, 1),
    }
    assert sorted(read(spark, path), key=str) == rows
    assert set(counts(spark, path).values()) == {1}
    assert compact(spark, path, "dt") == {}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["data"]


def test_bins_hold_about_the_target(spark, tmp_path):
    path = str(tmp_path / "data")
    rows = small_files(spark, path, days=2)
    size = file_bins(spark, path).agg(F.max("file_bytes")).first()[0]
    found = crowded_folders(spark, path, 4 * size).collect()
    assert {(r.files, r.bins) for r in found} == {(12, 3)}
    done = compact(spark, path, "dt", 4 * size)
    assert all(before == 12 and 1 <= after <= 3 for before, after in done.values())
    assert sorted(read(spark, path), key=str) == rows


def test_large_partitions_stay_untouched(spark, tmp_path):
    path = str(tmp_path / "data")
    small_files(spark, path)
    write_layer(spark.range(9).selectExpr("id", "'whole' AS dt"), path, mode="append", partition_by=["dt"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "data" / "dt=whole").iterdir()}
    assert "dt=whole" not in compact(spark, path, "dt")
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "data" / "dt=whole").iterdir()} == before


@pytest.mark.parametrize("lost_at", [1, 2, 3, 4])
def test_a_lost_swap_is_put_right(spark, tmp_path, monkeypatch, lost_at):
    path = str(tmp_path / "data")
    rows = small_files(spark, path)
    real, calls = compaction._rename, []

    def rename(*args):
        calls.append(args)
        if len(calls) == lost_at:
            raise RuntimeError("lost")
        real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(compaction, "_rename", rename)
        with pytest.raises(RuntimeError):
            compact(spark, path, "dt")
    mended = recover(spark, path, "dt")
    assert len(mended) == (1 if lost_at % 2 == 0 else 0)
    assert sorted(read(spark, path), key=str) == rows
    compact(spark, path, "dt")
    assert sorted(read(spark, path), key=str) == rows and set(counts(spark, path).values()) == {1}


def test_rows_that_come_meanwhile_are_not_lost(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "data")
    small_files(spark, path)
    real, calls = compaction.row_digests, []

    def digests(*args, **options):
        if not calls:
            more = spark.range(1).selectExpr("999 AS id", "'day/1' AS dt")
            write_layer(more, path, mode="append", partition_by=["dt"])
        calls.append(args)
        return real(*args, **options)

    monkeypatch.setattr(compaction, "row_digests", digests)
    with pytest.raises(ReconciliationFailed):
        compact(spark, path, "dt")
    assert (999, "day/1") in read(spark, path)


def profiled(spark):
    rows = [(f"d{i % 4}", i % 50, f"w{min(i % 100, 20)}", None if i % 5 else 0.5 * i) for i in range(4000)]
    return spark.createDataFrame(rows, "day string, n int, w string, x double")


def test_profile_of_a_range_without_a_frequent_value(spark, tmp_path):
    lines = spark.range(12000).selectExpr(
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "id % 6000 AS l_suppkey",
        "CASE WHEN id % 3 > 0 THEN 'R' END AS l_returnflag",
        "make_date(1990 + CAST(id DIV 9000 AS INT), 1, 1) AS l_shipdate",
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    listed = read_profile(merge_profiles(profile_parts(lines, [], ["l_suppkey"])), top=1).first()
    assert listed.top_values == []
    found = {r.column_name: r for r in QUERIES["profile_of_a_range"](spark, str(tmp_path)).collect()}
    assert sorted(found) == ["l_quantity", "l_returnflag", "l_suppkey"]
    assert all(r.row_count == 9000 and r.top_within and r.median_within for r in found.values())


def test_merged_profiles_equal_one_scan(spark, tmp_path):
    df, path = profiled(spark), str(tmp_path / "p")
    write_layer(profile_parts(df, ["day"]), path, partition_by=["day"])
    stored = read_layer(spark, path)
    found = {r.column_name: r for r in read_profile(merge_profiles(stored.where("day < 'd2'"))).collect()}
    part = df.where("day < 'd2'")
    assert set(found) == {"n", "w", "x"}
    for name, r in found.items():
        exact = part.agg(F.count(F.lit(1)), F.count(name), F.count_distinct(name)).first()
        assert (r.row_count, r.non_null_count) == tuple(exact)[:2]
        assert abs(r.distinct_count - exact[2]) <= max(1, 0.08 * exact[2])
    assert (found["n"].least, found["n"].most) == tuple(part.agg(F.min("n") * 1.0, F.max("n") * 1.0).first())
    assert found["w"].quantile_values is None and found["w"].least is None
    for q, value in zip((0.25, 0.5, 0.75), found["x"].quantile_values, strict=True):
        below = part.where(f"x <= {value}").count() / found["x"].non_null_count
        assert abs(below - q) < 0.05
    exact = part.groupBy("w").count().orderBy(F.desc("count"), "w").first()
    assert tuple(found["w"].top_values[0]) == tuple(exact)


def test_a_day_range_is_profiled_without_its_data(spark, tmp_path):
    data, path = tmp_path / "data", str(tmp_path / "p")
    write_layer(profiled(spark), str(data))
    write_layer(profile_parts(read_layer(spark, str(data)), ["day"]), path, partition_by=["day"])
    for file in data.glob("*.parquet"):
        file.write_bytes(b"not to be opened")
    merged = merge_profiles(read_layer(spark, path).where("day = 'd1'"))
    assert {r.row_count for r in read_profile(merged).collect()} == {1000}
    assert read_profile(merge_profiles(read_layer(spark, path).where("day = 'none'"))).count() == 0


def test_empty_columns_have_profiles_too(spark):
    df = spark.createDataFrame([("a", None, None)], "day string, x double, w string")
    rows = {r.column_name: r for r in read_profile(merge_profiles(profile_parts(df, ["day"]))).collect()}
    assert rows["x"].quantile_values is None and rows["x"].distinct_count == 0
    assert rows["w"].non_null_count == 0 and rows["w"].row_count == 1


def test_drift_names_files_columns_and_types(spark, tmp_path):
    path = str(tmp_path / "mixed")
    for expressions, files in ((["id", "1.5D AS v"], 3), (["1.5D AS v", "id"], 1), (["id", "'x' AS v", "id AS w"], 2)):
        for _ in range(files):
            write_layer(spark.range(4).selectExpr(*expressions).coalesce(1), path, mode="append")
    schemas = file_schemas(spark, path)
    versions = schema_versions(schemas).orderBy("files").collect()
    assert [(r.files, r.row_count) for r in versions] == [(2, 8), (4, 16)]
    found = {tuple(r) for r in column_drift(schemas).collect()}
    assert found == {
        ("id", "int64", 6, 24, 0),
        ("v", "double", 4, 16, 0),
        ("v", "string", 2, 8, 0),
        ("w", "int64", 2, 8, 4),
    }
    with pytest.raises(SchemaMismatch, match="4 files like"):
        require_one_schema(schemas)
    one = str(tmp_path / "one")
    write_layer(spark.range(4), one)
    require_one_schema(file_schemas(spark, one))


def test_rank_on_booleans(spark):
    df = spark.createDataFrame([(True, 1), (False, 2), (None, 3), (True, 4)], "b boolean, n int")
    found = {(r.n, r.rb, r.rn) for r in rank_by(df, {"b": "rb", "n": "rn"}).collect()}
    assert found == {(1, 1, 4), (4, 1, 1), (2, 3, 3), (3, 4, 2)}


def test_first_messages_in_one_read(spark):
    log = messages(spark, "t", 100, partitions=3)
    log = log.drop("timestamp")
    once, twice = consume(log, 7, look_first=False), consume(log, 7)
    assert once.collect() == twice.collect()
    assert plan_of(once).count("Range") == 1
    assert first_ends({0: 5, 1: 0}, 10) == {0: 15, 1: 10}
    options = kafka_options("b:9092", "t", False, ending=first_ends({0: 5, 1: 0}, 10))
    assert options["endingOffsets"] == '{"t": {"0": 15, "1": 10}}'


def test_names_and_constants(spark):
    df = spark.range(2).selectExpr("id", "'x' AS other")
    found = with_names(df, {"id": "nth"}, {"source": "s", "one": 1, "none": None})
    assert found.columns == ["nth", "source", "one", "none"]
    assert [tuple(r) for r in found.collect()] == [(0, "s", 1, None), (1, "s", 1, None)]
    with pytest.raises(SchemaMismatch):
        with_names(df, {"missing": "a"})
    with pytest.raises(SchemaMismatch):
        with_names(df, {"id": "a"}, {"a": 1})
