"""Sample events from landing to daily counts. Each step reads what the one before wrote."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.catalog import refresh_table
from strata.contracts import (
    DAILY_EVENT_COUNTS,
    EVENTS_BRONZE,
    EVENTS_SILVER,
    check_schema,
)
from strata.lake import DatasetRef, Lake
from strata.operators import conform_events, daily_event_counts, reconcile, require_reconciled
from strata.operators.conform import REJECTS
from strata.sinks import JobResult, write_layer
from strata.sources import read_layer, read_partitioned
from strata.workspace import delete_folder

EVENTS = DatasetRef("bronze", "demo", "sample_events")
EVENTS_GOLD = DatasetRef("gold", "demo", "daily_event_counts")


def land_events(
    events: DataFrame, lake: Lake, dynamic: bool = False, rebalance: bool = True
) -> JobResult:
    """Events (with ``dt``) to one landing folder per day; ``dynamic`` keeps the other days.

    Without ``rebalance`` there is no shuffle: right for a source already in day order.
    """
    check_schema(events, EVENTS_BRONZE)
    result = write_layer(
        events, lake.path(EVENTS), partition_by=["dt"], dynamic=dynamic, rebalance=rebalance
    )
    refresh_table(events.sparkSession, lake, EVENTS)
    return result


def build_events_silver(
    spark: SparkSession,
    lake: Lake,
    at: str | None = None,
    days: Sequence[str] | None = None,
    rebalance: bool = False,
) -> JobResult:
    """Bronze to date folders: everything anew, or only ``days`` while other days stay.

    ``days`` are replaced exactly: one that lands without rows has none afterwards. Landing days
    that are no date share one silver partition; if one of them is asked for, that partition is
    built from all of them. Landing already put each day's rows together, so this does not shuffle:
    silver gets at most one file per bronze file split. Rebalance if bronze is all small files.
    """
    ref = EVENTS.at("silver")
    bronze, silver = lake.path(EVENTS), lake.path(ref)
    landed = read_partitioned(spark, bronze, {"dt": "string"})
    if days is not None:
        undated = F.expr("try_cast(dt AS date) IS NULL")
        asked = F.col("dt").isin(*days)
        if any(_day(d) is None for d in days):
            asked = asked | undated
        landed = landed.where(asked)
        present = {r.dt for r in landed.select("dt").distinct().collect()}
    typed = conform_events(landed, at, REJECTS)
    check_schema(typed.drop(REJECTS), EVENTS_SILVER)
    result = write_layer(
        typed,
        silver,
        reads=[bronze],
        partition_by=["event_date"],
        dynamic=days is not None,
        rebalance=rebalance,
        metrics={"rejects": F.coalesce(F.sum(REJECTS), F.lit(0))},
        drop=[REJECTS],
    )
    if days is not None:
        kept = {_partition(d) for d in present}
        for gone in {_partition(d) for d in days} - kept:
            delete_folder(spark, f"{silver}/{gone}")
    refresh_table(spark, lake, ref)
    return result


def _day(text: str | None) -> date | None:
    """The date that silver makes of a landing day, as Spark's cast reads it."""
    try:
        return date.fromisoformat((text or "").strip())
    except ValueError:
        return None


def _partition(day: str | None) -> str:
    found = _day(day)
    return f"event_date={found.isoformat() if found else '__HIVE_DEFAULT_PARTITION__'}"


def build_events_gold(spark: SparkSession, lake: Lake, at: str | None = None) -> JobResult:
    silver = lake.path(EVENTS.at("silver"))
    counts = daily_event_counts(read_layer(spark, silver, EVENTS_SILVER), at)
    check_schema(counts, DAILY_EVENT_COUNTS)
    result = write_layer(counts, lake.path(EVENTS_GOLD), reads=[silver])
    refresh_table(spark, lake, EVENTS_GOLD)
    return result


def events_report(spark: SparkSession, lake: Lake) -> DataFrame:
    return reconcile(
        read_layer(spark, lake.path(EVENTS), EVENTS_BRONZE),
        read_layer(spark, lake.path(EVENTS.at("silver")), EVENTS_SILVER),
        read_layer(spark, lake.path(EVENTS_GOLD), DAILY_EVENT_COUNTS),
        "event_count",
    )


def run_events(
    spark: SparkSession, lake: Lake, events: DataFrame, at: str | None = None
) -> dict[str, JobResult]:
    """Landing, silver, gold and the row check, in order; an error in one stops the rest."""
    results = {
        "bronze": land_events(events, lake),
        "silver": build_events_silver(spark, lake, at),
        "gold": build_events_gold(spark, lake, at),
    }
    require_reconciled(events_report(spark, lake))
    return results
