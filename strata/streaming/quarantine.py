"""A stream to silver that keeps what does not fit: sound rows to silver, the others aside.

Each micro-batch is written twice, sound rows and rejects, both under the batch's number, which a
restart repeats exactly. So a batch that was lost between the two writes replaces itself, and every
source row is in one of the two places once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from strata.contracts import Conform
from strata.errors import SchemaMismatch
from strata.functions import stamp
from strata.operators.conform import conform, faults
from strata.sinks import JobResult
from strata.sinks.batches import append_batch

FAULTS = "faults"


def split_batch(
    rows: DataFrame,
    batch: int,
    fields: Sequence[Conform],
    silver: str,
    quarantine: str,
    at: str | None = None,
) -> dict[str, JobResult]:
    """One batch of bronze rows to both places. Rejects keep all bronze columns as they came, with
    the names of the values that did not fit."""
    if FAULTS in rows.columns:
        raise SchemaMismatch(f"bronze has a column {FAULTS} of its own")
    marked = rows.withColumn(FAULTS, faults(fields)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sound = conform(marked.where(F.size(FAULTS) == 0), fields)
        if "ingest_ts" not in sound.columns:
            sound = sound.withColumn("ingest_ts", stamp(at))
        rejects = marked.where(F.size(FAULTS) > 0).withColumn("rejected_ts", stamp(at))
        return {
            "silver": append_batch(sound, silver, batch),
            "quarantine": append_batch(rejects, quarantine, batch),
        }
    finally:
        marked.unpersist()


def to_silver_or_quarantine(
    bronze: DataFrame,
    fields: Sequence[Conform],
    silver: str,
    quarantine: str,
    checkpoint: str,
    at: str | None = None,
) -> DataStreamWriter:
    """Run it with ``run_available``, or start it with a trigger of its own."""

    def write(rows: DataFrame, batch: int) -> None:
        split_batch(rows, batch, fields, silver, quarantine, at)

    return bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def reject_report(quarantine: DataFrame) -> DataFrame:
    """How many rows each column's values sent to quarantine; a row may count for several."""
    return (
        quarantine.select(F.explode(FAULTS).alias("column_name"))
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )

