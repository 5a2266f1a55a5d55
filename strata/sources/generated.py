"""Rows made by Spark itself, for smoke runs of a lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import stamp, with_names


def generate_events(
    spark: SparkSession, n: int, day: str | None = None, at: str | None = None
) -> DataFrame:
    """``n`` events with ids from 0, value 1.0 and one ``dt`` (default: today in UTC)."""
    if day is None:
        dt = F.date_format(F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd")
    else:
        dt = F.lit(day)
    return with_names(spark.range(n), {"id": "event_id"}, {"ts": stamp(at), "value": 1.0, "dt": dt})
