from strata.streaming.flows import (
    daily_throughput,
    late_rows,
    open_windows,
    run_available,
    stream_files,
    stream_to_bronze,
    stream_to_silver,
    to_parquet,
)

from strata.streaming.late import (
    corrected_throughput,
    run_throughput,
    throughput_with_corrections,
    with_rocksdb,
)
from strata.streaming.quarantine import reject_report, split_batch, to_silver_or_quarantine

__all__ = [
    "corrected_throughput",
    "reject_report",
    "run_throughput",
    "split_batch",
    "throughput_with_corrections",
    "to_silver_or_quarantine",
    "with_rocksdb",
    "daily_throughput",
    "late_rows",
    "open_windows",
    "run_available",
    "stream_files",
    "stream_to_bronze",
    "stream_to_silver",
    "to_parquet",
]
