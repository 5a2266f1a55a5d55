import pytest

from strata.contracts import FLIGHTS_BRONZE, Column, check_schema, ddl
from strata.errors import InvalidName, SchemaMismatch
from strata.functions import snake_case, snake_case_columns
from strata.lake import DatasetRef, Lake, check_topic
from strata.session import object_store_conf
from strata.workspace import scratch_lake, scratch_root


def test_paths_and_tables():
    lake, ref = Lake("s3a://bucket/"), DatasetRef("silver", "aviation", "flights")
    assert lake.path(ref) == "s3a://bucket/silver/aviation/flights"
    assert lake.table(ref) == "silver.aviation_flights"
    assert lake.path(ref.at("gold")) == "s3a://bucket/gold/aviation/flights"
    assert Lake("/x", "dev_").table(ref) == "dev_silver.aviation_flights"
    assert lake.topic_path("a.b-c") == "s3a://bucket/topics/a.b-c"


@pytest.mark.parametrize("project", ["", "a b", "x;drop", "1st", "a.b", "../up"])
def test_bad_names_are_refused(project):
    with pytest.raises(InvalidName):
        DatasetRef("bronze", project, "x")


def test_bad_layer_prefix_and_topic():
    with pytest.raises(InvalidName):
        DatasetRef("copper", "a", "b")
    with pytest.raises(InvalidName):
        Lake("/x", "a-b")
    for topic in ("..", "a/b", "", "a b"):
        with pytest.raises(InvalidName):
            check_topic(topic)


@pytest.mark.parametrize(
    "name, wanted",
    [
        ("OP_UNIQUE_CARRIER", "op_unique_carrier"),
        ("opUniqueCarrier", "op_unique_carrier"),
        ("Op Unique-Carrier ", "op_unique_carrier"),
        ("a.b", "a_b"),
        ("X1", "x1"),
    ],
)
def test_snake_case(name, wanted):
    assert snake_case(name) == wanted


def test_snake_case_columns_keeps_values_and_refuses_clashes(spark):
    df = spark.createDataFrame([(1, 2)], ["My.Col", "B"])
    assert snake_case_columns(df).first().asDict() == {"my_col": 1, "b": 2}
    with pytest.raises(SchemaMismatch):
        snake_case_columns(spark.createDataFrame([(1, 2)], ["A b", "a_B"]).toDF("A_B", "A-B"))


def test_contract_check_names_every_problem(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    with pytest.raises(SchemaMismatch) as caught:
        check_schema(df, [Column("a", "bigint"), Column("b", "string")])
    text = str(caught.value)
    assert "missing b string" in text and "extra extra string" in text
    assert "a is int, not bigint" in text
    empty = spark.createDataFrame([], ddl(FLIGHTS_BRONZE))
    assert check_schema(empty, FLIGHTS_BRONZE) is empty


def test_object_store_conf():
    conf = object_store_conf("http://store:9000", "key", "secret")
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"


class _Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_scratch_is_shared_and_fresh(spark):
    one, two = scratch_lake(spark, "a"), scratch_lake(spark, "a")
    assert one.root != two.root and one.schema("gold") != two.schema("gold")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert one.root.endswith("/".join([scratch_root(spark), one.root.rsplit("/", 1)[1]]))
    # Without the setting the master plays no part: the folder is on the default file system.
    assert scratch_root(_Cluster) == "/tmp/strata-scratch"
