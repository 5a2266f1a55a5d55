"""Checks across layers. Each check reads every layer once and ends in few rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import Conform
from strata.errors import ReconciliationFailed
from strata.functions import rejected, typed


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def reconcile(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, gold_count: str
) -> DataFrame:
    """One row: rows of bronze and silver, rows that gold accounts for, gold rows, all equal?"""

    def counted(df: DataFrame, layer: str, accounted: Column) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"), accounted.alias("accounted")).withColumn(
            "layer", F.lit(layer)
        )

    every = F.count(F.lit(1))
    counts = _stack(
        [
            counted(bronze, "bronze", every),
            counted(silver, "silver", every),
            counted(gold, "gold", F.coalesce(F.sum(gold_count), F.lit(0)).cast("bigint")),
        ]
    )

    def of(layer: str, column: str) -> Column:
        return F.max(F.when(F.col("layer") == layer, F.col(column)))

    row = counts.agg(
        of("bronze", "n").alias("bronze_rows"),
        of("silver", "n").alias("silver_rows"),
        of("gold", "accounted").alias("gold_total"),
        of("gold", "n").alias("gold_rows"),
    )
    return row.withColumn(
        "reconciled",
        (F.col("bronze_rows") == F.col("silver_rows"))
        & (F.col("silver_rows") == F.col("gold_total"))
        & (F.col("gold_rows") > 0),
    )


def require_reconciled(report: DataFrame) -> dict[str, object]:
    """Run the one-row report and stop the flow if it does not hold."""
    found = report.first().asDict()
    if not found["reconciled"]:
        raise ReconciliationFailed(str(found))
    return found


def quality_profile(bronze: DataFrame, fields: Sequence[Conform]) -> DataFrame:
    """One row: rows and, per silver column, NULLs after typing and values that did not fit."""
    aggregates = [F.count(F.lit(1)).alias("row_count")]
    for f in fields:
        source = F.col(f.source)
        aggregates.append(F.count_if(typed(source, f.type).isNull()).alias(f"{f.name}_nulls"))
        aggregates.append(
            F.coalesce(F.sum(rejected(source, f.type)), F.lit(0)).alias(f"{f.name}_rejects")
        )
    return bronze.agg(*aggregates)


def lineage(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and last load time per source file in each layer that carries provenance."""
    return _stack(
        [
            df.groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("row_count"), F.max("ingest_ts").alias("last_ingest_ts"))
            .select(F.lit(layer).alias("layer"), "source_file", "row_count", "last_ingest_ts")
            for layer, df in layers.items()
        ]
    )
