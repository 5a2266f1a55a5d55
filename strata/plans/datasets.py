"""Any dataset from CSV to gold: a mapping for silver, a SELECT for gold, no code of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import refresh_table, register_table, run_sql
from strata.contracts import Conform
from strata.errors import SchemaMismatch
from strata.functions import snake_case_columns, with_provenance
from strata.lake import DatasetRef, Lake
from strata.operators.conform import REJECTS, conform
from strata.plans.models import model_args
from strata.sinks import JobResult, write_layer
from strata.sources import CORRUPT, read_csv_text, read_layer


def parse_mapping(texts: Sequence[str]) -> list[Conform]:
    """``source:type:name`` each; the name may be left out."""
    fields = []
    for text in texts:
        source, kind, *name = text.split(":")
        fields.append(Conform(source, kind, name[0] if name else source))
    return fields


def ingest_text(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    source: str,
    columns: Sequence[str] | None = None,
    label: str | None = None,
    at: str | None = None,
    multi_line: bool = False,
) -> JobResult:
    """CSV to bronze as raw text, with provenance; faulty lines are kept and counted.

    ``columns`` (in snake case) picks columns by name, in whatever order the header has them.
    """
    rows = with_provenance(read_csv_text(spark, source, multi_line), label, at)
    rows = snake_case_columns(rows)
    if columns is not None:
        missing = [c for c in columns if c not in rows.columns]
        if missing:
            raise SchemaMismatch(f"{source} has no columns {missing}")
        rows = rows.select(*columns, CORRUPT, "source_file", "ingest_ts")
    result = write_layer(
        rows, lake.path(ref), reads=[source], metrics={"malformed": F.count(CORRUPT)}
    )
    refresh_table(spark, lake, ref)
    return result


def build_silver(
    spark: SparkSession, lake: Lake, ref: DatasetRef, fields: Sequence[Conform]
) -> JobResult:
    """Bronze to silver by a mapping; values that do not fit become NULL and are counted."""
    bronze, silver = lake.path(ref.at("bronze")), lake.path(ref.at("silver"))
    result = write_layer(
        conform(read_layer(spark, bronze), fields, REJECTS),
        silver,
        reads=[bronze],
        metrics={"rejects": F.coalesce(F.sum(REJECTS), F.lit(0))},
        drop=[REJECTS],
    )
    refresh_table(spark, lake, ref.at("silver"))
    return result


def build_gold(
    spark: SparkSession, lake: Lake, ref: DatasetRef, select: str, at: str | None = None
) -> JobResult:
    """A SELECT (as in a model file) to the gold dataset ``ref``, and its table."""
    rows: DataFrame = run_sql(spark, select, model_args(lake, at))
    result = write_layer(rows, lake.path(ref.at("gold")))
    register_table(spark, lake, ref.at("gold"))
    return result
