"""From a gold row back to its sources.

Grouping by key and source at once gives, per gold row, how many rows each file gave to it. That table
adds up: over sources to the gold counts, over keys to what a file brought in, over parts of silver
to the whole. It stays a table of its own, one row per key and file, since a key of all files would
not fit one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.errors import ReconciliationFailed


def provenance(
    silver: DataFrame, keys: Sequence[str], source: str = "source_file", loaded: str = "ingest_ts"
) -> DataFrame:
    """``keys``, ``source``, ``row_count`` and ``last_ingest_ts``; combined in tasks first."""
    return silver.groupBy(*keys, source).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(loaded).alias("last_ingest_ts")
    )


def merge_provenance(parts: DataFrame, keys: Sequence[str], source: str = "source_file") -> DataFrame:
    """Provenance of several parts of silver, or for coarser ``keys`` (none: per source alone)."""
    return parts.groupBy(*keys, source).agg(
        F.sum("row_count").alias("row_count"), F.max("last_ingest_ts").alias("last_ingest_ts")
    )


def gold_lineage(parts: DataFrame, source: str = "source_file") -> DataFrame:
    """The gold part of a lineage report: what each source gave, in the columns of ``lineage``."""
    return merge_provenance(parts, (), source).select(
        F.lit("gold").alias("layer"), source, "row_count", "last_ingest_ts"
    )


def trace(gold: DataFrame, parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each gold row with every source it has rows from."""
    match = [gold[k].eqNullSafe(parts[k]) for k in keys]
    return gold.join(parts.select(*[F.col(c) for c in parts.columns]), match, "left").drop(
        *[parts[k] for k in keys]
    )


def require_lineage(report: DataFrame, source: str = "source_file") -> None:
    """Stop the flow unless every source has the same number of rows in each layer of ``report``."""
    layers = report.select("layer").distinct().count()
    apart = report.groupBy(source).agg(
        F.count(F.lit(1)).alias("layers"),
        F.min("row_count").alias("least"),
        F.max("row_count").alias("most"),
    )
    first = apart.where((F.col("layers") != layers) | (F.col("least") != F.col("most"))).limit(5).collect()
    if first:
        raise ReconciliationFailed(f"sources differ between layers: {[r.asDict() for r in first]}")
