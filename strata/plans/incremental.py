"""Work that follows only what is new: files not yet ingested, parts of silver that changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import refresh_table
from strata.contracts import Column, ddl
from strata.errors import ChangedSource, SchemaMismatch
from strata.functions import snake_case_columns, with_provenance
from strata.lake import DatasetRef, Lake
from strata.operators.states import merge_states, partial_states, state_fields
from strata.sinks import JobResult, write_layer
from strata.sinks.batches import (
    append_batch,
    batch_folder,
    commit_batch,
    committed_batches,
    read_batches,
)
from strata.sources import CORRUPT, list_files, read_csv_text, read_layer
from strata.workspace import delete_folder, partition_folder

_FILES = (
    Column("file_path", "string"),
    Column("file_bytes", "bigint"),
    Column("modified", "timestamp"),
)


def _listing(spark: SparkSession, source: str) -> DataFrame:
    found = list_files(spark, source)
    return found.select("file_path", "file_bytes", F.col("modificationTime").alias("modified"))


def ingested_files(spark: SparkSession, lake: Lake, ref: DatasetRef) -> DataFrame:
    """Every file that arrived, as it was then."""
    root = lake.manifest_path(ref)
    folders = [batch_folder(root, n) for n in committed_batches(spark, lake, ref)]
    if not folders:
        return spark.createDataFrame([], ddl(_FILES))
    return spark.read.schema(ddl(_FILES)).parquet(*folders)


def pending_files(spark: SparkSession, lake: Lake, ref: DatasetRef, source: str) -> DataFrame:
    """Files under ``source`` that have not arrived; one that arrived with other content is an error.

    No content is read. The manifest meets the listing in a join, however long both are.
    """
    known = ingested_files(spark, lake, ref).select(
        "file_path", F.col("file_bytes").alias("_bytes"), F.col("modified").alias("_modified")
    )
    met = _listing(spark, source).join(known, "file_path", "left")
    changed = met.where("file_bytes <> _bytes OR modified <> _modified").limit(5).collect()
    if changed:
        raise ChangedSource(f"changed since they were ingested: {[r.file_path for r in changed]}")
    return met.where("_bytes IS NULL").select("file_path", "file_bytes", "modified")


def ingest_new(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    source: str,
    at: str | None = None,
    read: Callable[[SparkSession, list[str]], DataFrame] | None = None,
) -> JobResult:
    """The files under ``source`` that are new, as the next batch of a bronze dataset.

    CSV as raw text unless ``read`` says otherwise; names in snake case, with provenance. A run
    without new files reads no row and writes nothing. A batch counts once its files are noted; one that was
    lost before is written again under its number. Names of new files are all that the driver sees
    (Spark lists them there in any read). Files of a batch must have the columns of those before.
    """
    given = read or read_csv_text
    files = pending_files(spark, lake, ref, source).orderBy("file_path").collect()
    done = committed_batches(spark, lake, ref)
    target = lake.path(ref)
    if not files:
        return JobResult(target, 0, {"files": 0, "batch": done[-1] if done else None})
    batch = done[-1] + 1 if done else 0
    rows = with_provenance(given(spark, [f.file_path for f in files]), None, at)
    rows = snake_case_columns(rows)
    if done:
        before = read_layer(spark, batch_folder(target, done[0])).schema
        wanted = [(f.name, f.dataType.simpleString()) for f in before]
        found = [(f.name, f.dataType.simpleString()) for f in rows.schema]
        if sorted(wanted) != sorted(found):
            raise SchemaMismatch(f"new files have columns {found}, those before {wanted}")
        rows = rows.select(*[name for name, _ in wanted])
    metrics = {"malformed": F.count(CORRUPT)} if CORRUPT in rows.columns else None
    result = append_batch(rows, target, batch, reads=[source], metrics=metrics)
    commit_batch(spark, lake, ref, batch, spark.createDataFrame(files, ddl(_FILES)))
    refresh_table(spark, lake, ref)
    return JobResult(target, result.rows, result.metrics | {"files": len(files), "batch": batch})


def update_states(
    df: DataFrame,
    path: str,
    part: str,
    keys: Sequence[str],
    values: Sequence[str] = (),
    parts: Sequence[str] | None = None,
) -> JobResult:
    """Partial states of ``df`` per ``part`` and ``keys``, stored in a folder per part.

    ``parts`` are the ones that changed: only they are read (the filter reaches the scan, and prunes
    folders if ``part`` is a folder key) and replaced exactly; one without rows has no states then.
    Without ``parts`` everything is built anew. ``part`` is compared as text.
    """
    named = df.withColumn(part, F.col(part).cast("string"))
    if parts is None:
        states = partial_states(named, [part, *keys], values)
        return write_layer(states, path, partition_by=[part])
    if not parts:
        return JobResult(path, 0)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    asked = [F.lit(p).cast(kinds[part]) for p in parts]
    states = partial_states(
        df.where(F.col(part).isin(*asked)).withColumn(part, F.col(part).cast("string")),
        [part, *keys],
        values,
    )
    result = write_layer(
        states,
        path,
        partition_by=[part],
        dynamic=True,
        metrics={"parts": F.collect_set(part)},
    )
    for gone in set(parts) - set(result.metrics["parts"]):
        delete_folder(df.sparkSession, partition_folder(df.sparkSession, path, part, gone))
    return result


def read_states(
    spark: SparkSession,
    path: str,
    part: str,
    keys: Sequence[Column],
    values: Sequence[str] = (),
) -> DataFrame:
    """Stored states; a filter on ``part`` (text) prunes folders."""
    columns = (*keys, *state_fields(values), Column(part, "string"))
    return read_layer(spark, path, columns)


def merged_gold(
    spark: SparkSession,
    path: str,
    part: str,
    keys: Sequence[Column],
    values: Sequence[str] = (),
) -> DataFrame:
    """States merged over all parts; silver is not read."""
    states = read_states(spark, path, part, keys, values)
    return merge_states(states, [k.name for k in keys], values)


__all__ = [
    "ingest_new",
    "ingested_files",
    "merged_gold",
    "pending_files",
    "read_batches",
    "read_states",
    "update_states",
]
