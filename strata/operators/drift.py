"""Schema drift: which columns and types do the files of a folder have, and which files differ?

Tasks read the footers of the listed files, nothing else of them; each file gives its columns, which are
grouped by a digest. The driver sees no footer. Footers are opened through pyarrow's file systems
(local, hdfs, s3, gs), since Spark's own Parquet reader gives all files one schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.errors import SchemaMismatch
from strata.sources import list_files

_SCHEMA = "file_path string, row_count bigint, columns array<struct<name:string,type:string>>"


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, place = fs.FileSystem.from_uri(path)
            with system.open_input_file(place) as file:
                footer = pq.ParquetFile(file)
                fields = [{"name": f.name, "type": str(f.type)} for f in footer.schema_arrow]
                rows = footer.metadata.num_rows
            struct = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([rows], pa.int64()), pa.array([fields], struct)],
                names=["file_path", "row_count", "columns"],
            )


def file_schemas(spark: SparkSession, path: str) -> DataFrame:
    """Per Parquet file under ``path``: its rows and its columns (names and types, in order)."""
    files = list_files(spark, path).where(F.col("file_path").endswith(".parquet"))
    uri = F.regexp_replace("file_path", "^file:/+", "file:///")
    return files.select(uri.alias("file_path")).mapInArrow(_footers, _SCHEMA)


def schema_versions(schemas: DataFrame) -> DataFrame:
    """Per distinct schema, whatever the order of columns: ``files``, ``row_count``, its columns and
    the first file that has it."""
    sorted_columns = F.sort_array("columns")
    return (
        schemas.withColumn("columns", sorted_columns)
        .groupBy(F.xxhash64("columns").alias("schema_digest"), "columns")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("row_count").alias("row_count"),
            F.min("file_path").alias("first_file"),
        )
    )


def column_drift(schemas: DataFrame) -> DataFrame:
    """Per column and type: how many files (and rows in them) have it, and how many do not have a
    column of that name at all."""
    listed = schemas.select("file_path", "row_count", F.explode("columns").alias("c"))
    per_type = listed.groupBy(F.col("c.name").alias("column_name"), F.col("c.type").alias("data_type"))
    found = per_type.agg(F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"))
    named = found.groupBy("column_name").agg(F.sum("files").alias("_with"))
    total = schemas.agg(F.count(F.lit(1)).alias("n")).scalar()
    return found.join(named, "column_name").select(
        "column_name", "data_type", "files", "row_count", (total - F.col("_with")).alias("files_without")
    )


def require_one_schema(schemas: DataFrame) -> None:
    """Stop the flow if the files have more than one schema; the message names a file of each."""
    versions = schema_versions(schemas).orderBy(F.desc("files")).limit(5).collect()
    if len(versions) > 1:
        shown = [f"{r.files} files like {r.first_file}" for r in versions]
        raise SchemaMismatch(f"files have different schemas: {'; '.join(shown)}")
