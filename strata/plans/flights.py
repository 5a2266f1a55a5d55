"""Flights from staging CSV to carrier metrics. Each step reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import refresh_table
from strata.contracts import (
    CARRIER_SUMMARY,
    FLIGHTS_RAW,
    FLIGHTS_SILVER,
    FLIGHTS_STAGING,
    Column,
    check_schema,
)
from strata.functions import snake_case_columns, with_provenance
from strata.lake import DatasetRef, Lake
from strata.operators import (
    carrier_summary,
    conform_flights,
    reconcile,
    require_reconciled,
    require_same_rows,
)
from strata.operators.conform import REJECTS
from strata.plans.datasets import ingest_text
from strata.plans.ledger import Ledger, listing_digest
from strata.sinks import JobResult, write_layer
from strata.sources import CORRUPT, read_csv, read_layer

FLIGHTS = DatasetRef("bronze", "aviation", "flights")
FLIGHTS_GOLD = DatasetRef("gold", "aviation", "carrier_summary")


def ingest_csv(
    spark: SparkSession,
    lake: Lake,
    ref: DatasetRef,
    source: str,
    columns: Sequence[Column] | None = None,
    label: str | None = None,
    at: str | None = None,
    rename: bool = True,
) -> JobResult:
    """Any CSV source to its bronze dataset: all its columns plus provenance."""
    rows = with_provenance(read_csv(spark, source, columns), label, at)
    if rename:
        rows = snake_case_columns(rows)
    result = write_layer(rows, lake.path(ref), reads=[source])
    refresh_table(spark, lake, ref)
    return result


def ingest_flights(
    spark: SparkSession, lake: Lake, source: str, label: str | None = None, at: str | None = None
) -> JobResult:
    return ingest_csv(spark, lake, FLIGHTS, source, FLIGHTS_STAGING, label, at)


def land_flights(
    spark: SparkSession, lake: Lake, source: str, label: str | None = None, at: str | None = None
) -> JobResult:
    """Flights as the files have them: text, so that silver sees and counts what does not fit."""
    columns = [c.name for c in FLIGHTS_RAW if c.name not in (CORRUPT, "source_file", "ingest_ts")]
    return ingest_text(spark, lake, FLIGHTS, source, columns, label, at)


def build_flights_silver(spark: SparkSession, lake: Lake) -> JobResult:
    bronze, silver = lake.path(FLIGHTS), lake.path(FLIGHTS.at("silver"))
    typed = conform_flights(read_layer(spark, bronze), REJECTS)
    check_schema(typed.drop(REJECTS), FLIGHTS_SILVER)
    result = write_layer(
        typed,
        silver,
        reads=[bronze],
        metrics={"rejects": F.coalesce(F.sum(REJECTS), F.lit(0))},
        drop=[REJECTS],
    )
    refresh_table(spark, lake, FLIGHTS.at("silver"))
    return result


def build_flights_gold(spark: SparkSession, lake: Lake, at: str | None = None) -> JobResult:
    silver = lake.path(FLIGHTS.at("silver"))
    summary = carrier_summary(read_layer(spark, silver, FLIGHTS_SILVER), at)
    check_schema(summary, CARRIER_SUMMARY)
    result = write_layer(summary, lake.path(FLIGHTS_GOLD), reads=[silver])
    refresh_table(spark, lake, FLIGHTS_GOLD)
    return result


def flights_report(spark: SparkSession, lake: Lake) -> DataFrame:
    return reconcile(
        read_layer(spark, lake.path(FLIGHTS)),
        read_layer(spark, lake.path(FLIGHTS.at("silver")), FLIGHTS_SILVER),
        read_layer(spark, lake.path(FLIGHTS_GOLD), CARRIER_SUMMARY),
        "flight_count",
    )


def check_flights(spark: SparkSession, lake: Lake) -> None:
    """Row by row: silver is what conforming makes of bronze, nothing lost, doubled or changed."""
    bronze = conform_flights(read_layer(spark, lake.path(FLIGHTS), FLIGHTS_RAW))
    silver = read_layer(spark, lake.path(FLIGHTS.at("silver")), FLIGHTS_SILVER)
    require_same_rows(bronze, silver, silver.columns)


def run_flights(
    spark: SparkSession,
    lake: Lake,
    source: str,
    label: str | None = None,
    at: str | None = None,
    resume: bool = False,
    check_rows: bool = False,
) -> dict[str, JobResult]:
    """Raw landing, silver, gold and the row check, in order; an error in one stops the rest.

    Lines with too few or too many fields and values that do not fit are counted, as ``malformed`` of
    bronze and ``rejects`` of silver. With ``resume`` a step that is finished, from the same files and
    settings, is not run again. ``check_rows`` compares rows, not only their number, which reads bronze and
    silver once more.
    """
    steps = {
        "bronze": lambda: land_flights(spark, lake, source, label, at),
        "silver": lambda: build_flights_silver(spark, lake),
        "gold": lambda: build_flights_gold(spark, lake, at),
    }
    if resume:
        ledger = Ledger(spark, lake, "flights")
        inputs = {"bronze": [listing_digest(spark, source), str(label), str(at)], "gold": [str(at)]}
        results = {
            name: ledger.step(name, inputs.get(name, []), action) for name, action in steps.items()
        }
    else:
        results = {name: action() for name, action in steps.items()}
    require_reconciled(flights_report(spark, lake))
    if check_rows:
        check_flights(spark, lake)
    return results
