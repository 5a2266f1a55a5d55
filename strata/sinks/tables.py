"""Writes to catalog tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def append_table(df: DataFrame, table: str) -> None:
    """Append rows, matched by name; the first append creates the table.

    A three-part name points to a table-format catalog set up in the session's configuration.
    """
    if table.count(".") < 2:
        df.write.mode("append").saveAsTable(table)
    elif df.sparkSession.catalog.tableExists(table):
        df.writeTo(table).append()
    else:
        df.writeTo(table).create()


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the rows of an existing table; building twice leaves them there once."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def insert_select(
    spark: SparkSession, table: str, select: str, args: Mapping[str, object] | None = None
) -> None:
    """The same for SQL text: columns go by name, rows replace what the table holds."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} BY NAME\n{select}", args=args)
