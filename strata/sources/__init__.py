from strata.sources.csv import CORRUPT, read_csv, read_csv_text
from strata.sources.files import (
    file_inventory,
    inventory_by_partition,
    list_files,
    read_layer,
    read_partition,
    read_partitioned,
)
from strata.sources.generated import generate_events
from strata.sources.topics import (
    consume,
    consume_kafka,
    first_ends,
    kafka_options,
    read_all_topics,
    read_kafka,
    read_topic,
    topic_summary,
)

__all__ = [
    "CORRUPT",
    "list_files",
    "read_csv_text",
    "consume",
    "consume_kafka",
    "first_ends",
    "file_inventory",
    "generate_events",
    "inventory_by_partition",
    "kafka_options",
    "read_all_topics",
    "read_csv",
    "read_kafka",
    "read_layer",
    "read_partition",
    "read_partitioned",
    "read_topic",
    "topic_summary",
]
