import pytest
from pyspark.sql import functions as F

from strata.contracts import TOPIC_MESSAGES, check_schema
from strata.errors import InvalidName, SchemaMismatch
from strata.sinks import messages, produce, publish
from strata.sources import consume, kafka_options, read_kafka, read_topic, topic_summary


def test_round_trip_of_ten(spark, lake):
    assert produce(spark, lake, "demo.events").rows == 10
    log = read_topic(spark, lake, "demo.events")
    check_schema(log, TOPIC_MESSAGES)
    rows = [(r.partition, r.offset, r.value) for r in consume(log, 10).collect()]
    assert rows == [(0, i, f"event_{i + 1}") for i in range(10)]
    assert len(consume(log, 3).collect()) == 3 and consume(log, 3).first().value == "event_1"


def test_next_producer_goes_on_with_the_offsets(spark, lake):
    produce(spark, lake, "t", 4, partitions=3)
    produce(spark, lake, "t", 5, "again_", partitions=4)
    log = read_topic(spark, lake, "t")
    by_partition = {}
    for r in log.orderBy("partition", "offset").collect():
        by_partition.setdefault(r.partition, []).append((r.offset, r.value))
    assert by_partition == {
        0: [(0, "event_1"), (1, "event_4"), (2, "again_1"), (3, "again_5")],
        1: [(0, "event_2"), (1, "again_2")],
        2: [(0, "event_3"), (1, "again_3")],
        3: [(0, "again_4")],
    }
    summary = {r.partition: tuple(r)[2:] for r in topic_summary(log).collect()}
    assert summary == {0: (0, 3, 4), 1: (0, 1, 2), 2: (0, 1, 2), 3: (0, 0, 1)}


def test_messages_need_no_shuffle(spark):
    plan = messages(spark, "t", 1000, partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_publish_checks_the_columns(spark, lake):
    with pytest.raises(SchemaMismatch):
        publish(spark.range(1), lake, "t")
    with pytest.raises(InvalidName):
        publish(messages(spark, "t", 1), lake, "../t")


def test_summary_of_several_topics(spark):
    log = messages(spark, "a", 5).unionByName(messages(spark, "b", 2).withColumn("offset", F.col("offset") + 7))
    found = {tuple(r) for r in topic_summary(log).collect()}
    assert found == {("a", 0, 0, 4, 5), ("b", 0, 7, 8, 2)}


def test_broker_options():
    assert kafka_options("b:9092", "t", stream=False) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    assert kafka_options("b:9092", "t", True, "latest", 500) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "500",
    }


def test_broker_source_without_the_connector_says_so(spark):
    with pytest.raises(Exception, match="kafka"):
        read_kafka(spark, "b:9092", "t")
