"""What a table looks like: columns, types, NULLs, distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame) -> DataFrame:
    """Column names and types, from metadata alone."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string")


def profile(df: DataFrame, distinct: str | None = "exact") -> DataFrame:
    """One row per column: type, rows, non-NULL rows and distinct values.

    ``distinct``: ``"exact"`` groups each column on its own, so a stored table is read once per
    column, that column only, and narrow rows are shuffled; equal values meet in each task
    first. ``"approx"`` merges small sketches in one scan and is the choice for very long tables.
    None leaves it out.
    """
    return _exact(df) if distinct == "exact" else _one_scan(df, distinct == "approx")


def _exact(df: DataFrame) -> DataFrame:
    def of(name: str, kind: str) -> DataFrame:
        value, rows = F.col("_value"), F.col("_rows")
        counted = df.groupBy(F.col(f"`{name}`").alias("_value")).agg(
            F.count(F.lit(1)).alias("_rows")
        )
        return counted.agg(
            F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(value.isNotNull(), rows)), F.lit(0)).alias("non_null_count"),
            F.count(value).alias("distinct_count"),
        ).select(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), "*")

    kinds = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return reduce(DataFrame.unionByName, [of(name, kind) for name, kind in kinds])


def _one_scan(df: DataFrame, distinct: bool) -> DataFrame:
    aggregates, lines = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(df.schema.fields):
        column = F.col(f"`{f.name}`")
        aggregates.append(F.count(column).alias(f"known_{i}"))
        line = [
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("rows").alias("row_count"),
            F.col(f"known_{i}").alias("non_null_count"),
        ]
        if distinct:
            aggregates.append(F.approx_count_distinct(column).alias(f"distinct_{i}"))
            line.append(F.col(f"distinct_{i}").alias("distinct_count"))
        lines.append(F.struct(*line))
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))


def null_profile(df: DataFrame) -> DataFrame:
    """One row: row count and, per column, how many values are NULL."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"{c}_nulls") for c in df.columns]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *nulls)
