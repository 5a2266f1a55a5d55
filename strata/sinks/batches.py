"""Appends under a batch number: a retry replaces what the attempt before left behind.

A dataset of batches is a folder of ``batch_id=<n>/`` folders. A batch counts as arrived when its note in
the dataset's manifest is whole; the note is the last thing written. So a job that is lost anywhere
on the way is simply run again, under the same number.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.errors import InvalidName
from strata.lake import DatasetRef, Lake
from strata.sinks.layers import JobResult, write_layer
from strata.workspace import child_folders, is_complete

BATCH = "batch_id"


def batch_folder(path: str, batch: int) -> str:
    if batch < 0:
        raise InvalidName(f"not a batch number: {batch}")
    return f"{path.rstrip('/')}/{BATCH}={batch}"


def append_batch(
    df: DataFrame,
    path: str,
    batch: int,
    *,
    reads: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> JobResult:
    """Write ``df`` as batch number ``batch`` of ``path``; run twice, its rows are there once.

    The whole folder of the batch is replaced, also by no rows at all. Other batches stay.
    """
    return write_layer(df, batch_folder(path, batch), reads=reads, metrics=metrics, drop=drop)


def commit_batch(spark: SparkSession, lake: Lake, ref: DatasetRef, batch: int, note: DataFrame) -> None:
    """Note that the batch arrived; ``note`` (a few rows, such as the files taken) is kept with it."""
    note.coalesce(1).write.mode("overwrite").parquet(batch_folder(lake.manifest_path(ref), batch))


def committed_batches(spark: SparkSession, lake: Lake, ref: DatasetRef) -> list[int]:
    """Numbers of the batches that arrived, ascending; one name per batch comes to the driver."""
    root = lake.manifest_path(ref)
    names = [n for n in child_folders(spark, root) if n.startswith(f"{BATCH}=")]
    found = sorted(int(n.partition("=")[2]) for n in names)
    return [n for n in found if is_complete(spark, batch_folder(root, n))]


def read_batches(spark: SparkSession, lake: Lake, ref: DatasetRef) -> DataFrame:
    """Rows of the batches that arrived, with ``batch_id``; others are not opened."""
    path, batches = lake.path(ref), committed_batches(spark, lake, ref)
    if not batches:
        raise InvalidName(f"{path} has no batches")
    folders = [batch_folder(path, n) for n in batches]
    rows = spark.read.option("basePath", path).parquet(*folders)
    return rows.withColumn(BATCH, F.col(BATCH).cast("bigint"))
