"""Layers and tables in the session catalog. Tables are external: metadata over files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import Column, ddl
from strata.lake import DatasetRef, Lake, check_identifier
from strata.sources.files import read_partitioned


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_sql(spark: SparkSession, text: str, args: dict[str, object] | None = None) -> DataFrame:
    """One SQL statement as it is, with optional named parameters (``:name``)."""
    return spark.sql(text, args=args)


def run_script(spark: SparkSession, text: str) -> DataFrame:
    """Several statements, each closed by ``;``, run in order. The last query is the result."""
    return spark.sql(f"BEGIN\n{text}\nEND")


def ensure_layer(spark: SparkSession, lake: Lake, layer: str) -> str:
    schema = lake.schema(layer)
    location = _quoted(lake.layer_path(layer))
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION {location}")
    return schema


def list_tables(spark: SparkSession, lake: Lake, layer: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(lake.schema(layer)))


def drop_table(spark: SparkSession, lake: Lake, ref: DatasetRef) -> None:
    """Forget the table; files of an external table stay."""
    spark.sql(f"DROP TABLE IF EXISTS {lake.table(ref)}")


def register_table(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    *,
    location: str | None = None,
    day: str | None = None,
    key: str = "dt",
    drop_first: bool = True,
) -> str:
    """Table over a dataset's files, or over one landing day. Columns come from the files.

    ``location`` registers files that lie elsewhere under this name. Without ``drop_first`` an
    existing table is an error. A root of ``key=value/`` folders shows all its partitions.
    """
    ensure_layer(spark, lake, ref.layer)
    if drop_first:
        drop_table(spark, lake, ref)
    path = location or lake.path(ref)
    if day is not None:
        path = f"{path}/{check_identifier(key)}={date.fromisoformat(day)}"
    table = lake.table(ref)
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION {_quoted(path)}")
    if _is_partitioned(spark, table):
        sync_partitions(spark, lake, ref)
    return table


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def refresh_table(spark: SparkSession, lake: Lake, ref: DatasetRef) -> None:
    """Let a registered table see new files; a dataset that is no table needs nothing."""
    table = lake.table(ref)
    if not spark.catalog.tableExists(table):
        return
    spark.catalog.refreshTable(table)
    if _is_partitioned(spark, table):
        sync_partitions(spark, lake, ref)


def _columns_of(spark: SparkSession, path: str, keys: Sequence[str]) -> list[Column]:
    """Columns as Spark finds them, but a key whose guessed type changes its text stays text."""
    found = [Column(f.name, f.dataType.simpleString()) for f in spark.read.parquet(path).schema]
    guessed = {c.name: c.type for c in found if c.name in keys and c.type != "string"}
    texts = read_partitioned(spark, path, dict.fromkeys(keys, "string")).select(*keys).distinct()
    for key, kind in guessed.items():
        back = F.col(key).try_cast(kind).cast("string")
        if texts.where(~back.eqNullSafe(F.col(key))).isEmpty():
            continue
        found = [Column(key, "string") if c.name == key else c for c in found]
    return found


def register_partitioned_table(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    partition_by: Sequence[str],
    columns: Sequence[Column] | None = None,
    sync: bool = True,
) -> str:
    """Table over ``key=value/`` folders. It shows no rows until its partitions are synced."""
    ensure_layer(spark, lake, ref.layer)
    path = lake.path(ref)
    if columns is None:
        columns = _columns_of(spark, path, partition_by)
    keys = ", ".join(f"`{check_identifier(k)}`" for k in partition_by)
    table = lake.table(ref)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl(columns)}) USING parquet"
        f" PARTITIONED BY ({keys}) LOCATION {_quoted(path)}"
    )
    if sync:
        sync_partitions(spark, lake, ref)
    return table


def sync_partitions(spark: SparkSession, lake: Lake, ref: DatasetRef) -> None:
    """Add partitions whose folders appeared and remove those whose folders are gone."""
    spark.sql(f"MSCK REPAIR TABLE {lake.table(ref)} SYNC PARTITIONS")


def sample(spark: SparkSession, lake: Lake, ref: DatasetRef, n: int | None = None) -> DataFrame:
    """Some ``n`` rows in no order; 5 by default for bronze, 10 for silver and gold."""
    if n is None:
        n = 5 if ref.layer == "bronze" else 10
    return spark.table(lake.table(ref)).limit(n)
