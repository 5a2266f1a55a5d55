"""Parquet datasets, their partitions and their files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column as SqlColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import Column, ddl


def read_layer(
    spark: SparkSession, path: str, columns: Sequence[Column] | None = None
) -> DataFrame:
    """Scan a dataset folder; given ``columns`` no file footer is read to find the schema."""
    reader = spark.read
    if columns is not None:
        reader = reader.schema(ddl(columns))
    return reader.parquet(path)


def read_partitioned(spark: SparkSession, root: str, keys: Mapping[str, str]) -> DataFrame:
    """Scan a root of ``key=value/`` folders, each key with the type asked for.

    Spark guesses key types from folder names (``hour=07`` becomes the number 7), and a cast of the
    guess does not give the text back. So the folders are read with a schema that has the types
    asked for; filters on the keys prune folders.
    """
    found = spark.read.parquet(root).schema
    columns = [Column(f.name, keys.get(f.name, f.dataType.simpleString())) for f in found.fields]
    return spark.read.schema(ddl(columns)).parquet(root)


def read_partition(
    spark: SparkSession, root: str, key: str, value: object | SqlColumn
) -> DataFrame:
    """Rows of one partition; other folders are not opened.

    A text ``value`` is compared with the folder's text, and the key comes back as text. Any other
    is compared with what Spark makes of the folder names; it may be a scalar subquery, which Spark
    runs before it lists what to read.
    """
    if isinstance(value, str):
        return read_partitioned(spark, root, {key: "string"}).where(F.col(key) == value)
    return spark.read.parquet(root).where(F.col(key) == value)


def file_inventory(spark: SparkSession, path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Files under ``path`` with bytes and rows (and partition keys). No data column is read.

    Files without rows do not show up.
    """
    return (
        spark.read.parquet(path)
        .groupBy(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_bytes"),
            *keys,
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def list_files(spark: SparkSession, prefix: str) -> DataFrame:
    """Every file under a prefix, of any kind and also without rows; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(prefix)
    return found.select(
        F.col("path").alias("file_path"), F.col("length").alias("file_bytes"), "modificationTime"
    )


def inventory_by_partition(inventory: DataFrame, *keys: str) -> DataFrame:
    return inventory.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_bytes").alias("total_bytes"),
        F.sum("row_count").alias("row_count"),
    )
