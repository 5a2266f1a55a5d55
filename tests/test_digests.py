"""Row-level reconciliation."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.errors import ReconciliationFailed, SchemaMismatch
from strata.operators import (
    differing_buckets,
    differing_rows,
    merge_digests,
    reconcile,
    require_same_rows,
    row_digests,
)
from strata.sinks import write_layer
from strata.sources import read_partitioned
from tests.conftest import plan_of

COLUMNS = ["id", "name", "value"]
SCHEMA = "id long, name string, value double"
ROWS = [(i, None if i % 4 == 0 else f"n{i % 3}", i / 3) for i in range(40)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return sorted(((r.id, r.name, r.value, r.left_rows, r.right_rows) for r in df.collect()), key=str)


def test_counts_agree_but_rows_do_not(spark):
    left = frame(spark, ROWS)
    right = frame(spark, [*ROWS[1:], ROWS[7]])
    gold = spark.createDataFrame([(40,)], "n long")
    assert reconcile(left, right, gold, "n").first().reconciled
    assert found(differing_rows(left, right, COLUMNS)) == sorted(
        [(*ROWS[0], 1, 0), (*ROWS[7], 1, 2)], key=str
    )
    with pytest.raises(ReconciliationFailed, match="left_rows"):
        require_same_rows(left, right, COLUMNS)


def test_order_and_partitions_do_not_matter(spark):
    left, right = frame(spark, ROWS * 2), frame(spark, ROWS[::-1] * 2).repartition(7)
    assert found(differing_rows(left, right, COLUMNS, identity=["id"])) == []
    require_same_rows(left, right, COLUMNS, by=["name"])


def test_changed_values_meet_in_one_bucket(spark):
    left = frame(spark, ROWS)
    right = frame(spark, [(i, n, 99.0 if i == 5 else v) for i, n, v in ROWS])
    rows = differing_rows(left, right, COLUMNS, identity=["id"]).collect()
    assert len(rows) == 2 and len({r.bucket for r in rows}) == 1
    assert {r.id for r in rows} == {5}


def test_nulls_that_change_places_are_seen(spark):
    schema = "a string, b string"
    left = spark.createDataFrame([(None, "x")], schema)
    right = spark.createDataFrame([("x", None)], schema)
    assert differing_rows(left, right, ["a", "b"]).count() == 2


def test_empty_sides_and_other_columns(spark):
    left = frame(spark, ROWS).selectExpr("*", "1 AS bucket_of_mine")
    assert differing_rows(frame(spark, []), frame(spark, []), COLUMNS).count() == 0
    assert differing_rows(left, frame(spark, []), COLUMNS).count() == 40
    with pytest.raises(SchemaMismatch, match="value is double"):
        differing_rows(left, left.withColumn("value", left.value.cast("string")), COLUMNS)


def test_digests_of_parts_add_up(spark):
    whole = row_digests(frame(spark, ROWS), COLUMNS)
    parts = row_digests(frame(spark, ROWS[:11]), COLUMNS).unionByName(
        row_digests(frame(spark, ROWS[11:]), COLUMNS)
    )
    assert differing_buckets(whole, merge_digests(parts)).count() == 0


def test_only_differing_folders_are_read_again(spark, tmp_path):
    left, right = str(tmp_path / "l"), str(tmp_path / "r")
    rows = frame(spark, ROWS).selectExpr("*", "CAST(id % 10 AS string) AS part")
    write_layer(rows, left, partition_by=["part"])
    write_layer(rows.where("id <> 33"), right, partition_by=["part"])
    both = [read_partitioned(spark, p, {"part": "string"}) for p in (left, right)]
    apart = differing_rows(*both, COLUMNS, by=["part"])
    assert [(r.id, r.part) for r in apart.collect()] == [(33, "3")]
    assert re.search(r"PartitionFilters: \[[^\]]*part#", plan_of(apart)), plan_of(apart)
    both[1] = both[1].where("part <> '7'").unionByName(both[1].where("part = '7'").withColumn("part", F.lit(None).cast("string")))
    assert differing_rows(*both, COLUMNS, by=["part"]).count() == 9


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from([None, "a", ""]), st.sampled_from([None, 0.5])), max_size=8),
    st.lists(st.tuples(st.integers(0, 3), st.sampled_from([None, "a", ""]), st.sampled_from([None, 0.5])), max_size=8),
)
def test_equals_counting(spark, a, b):
    wanted = [(*row, a.count(row), b.count(row)) for row in {*a, *b} if a.count(row) != b.count(row)]
    assert found(differing_rows(frame(spark, a), frame(spark, b), COLUMNS, buckets=3)) == sorted(wanted, key=str)
