from strata.sinks.batches import (
    append_batch,
    commit_batch,
    committed_batches,
    read_batches,
)
from strata.sinks.compaction import compact, crowded_folders, file_bins, recover
from strata.sinks.layers import JobResult, land_day, write_layer
from strata.sinks.tables import append_table, insert_select, overwrite_table
from strata.sinks.topics import append_rows, log_ends, messages, produce, publish, write_kafka

__all__ = [
    "compact",
    "crowded_folders",
    "file_bins",
    "recover",
    "append_batch",
    "commit_batch",
    "committed_batches",
    "read_batches",
    "append_rows",
    "log_ends",
    "JobResult",
    "append_table",
    "insert_select",
    "land_day",
    "messages",
    "overwrite_table",
    "produce",
    "publish",
    "write_kafka",
    "write_layer",
]
