"""Silver to gold: grouped metrics.

Every aggregate here combines inside each task before the shuffle, so a key that holds a large
share of the rows still sends one small row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import stamp, wall_clock_stamp


def _rows() -> Column:
    return F.count(F.lit(1))


def _grouped(df: DataFrame, key: str, metrics: dict[str, Column]) -> DataFrame:
    return df.groupBy(key).agg(*[metric.alias(name) for name, metric in metrics.items()])


def daily_event_counts(silver: DataFrame, at: str | None = None) -> DataFrame:
    counts = _grouped(silver, "event_date", {"event_count": _rows()})
    return counts.withColumn("load_ts", stamp(at))


def carrier_summary(silver: DataFrame, at: str | None = None) -> DataFrame:
    """Flights, mean delays, cancellations and mean distance per carrier.

    Means skip NULL delays; a carrier with none known gets NULL.
    """
    metrics = {
        "flight_count": _rows(),
        "avg_dep_delay_minutes": F.avg("dep_delay_minutes"),
        "avg_arr_delay_minutes": F.avg("arr_delay_minutes"),
        "cancelled_count": F.sum("cancelled_flag"),
        "avg_distance_miles": F.avg("distance_miles"),
    }
    return _grouped(silver, "carrier", metrics).withColumn("load_ts", stamp(at))


def carrier_delay_spread(silver: DataFrame, at: str | None = None) -> DataFrame:
    """Mean and sample deviation of delays per carrier; one known value has no deviation."""
    metrics = {
        "flight_count": _rows(),
        "avg_arr_delay": F.avg("arr_delay_minutes"),
        "avg_dep_delay": F.avg("dep_delay_minutes"),
        "std_arr_delay": F.stddev_samp("arr_delay_minutes"),
        "std_dep_delay": F.stddev_samp("dep_delay_minutes"),
    }
    return _grouped(silver, "carrier", metrics).withColumn("built_at", wall_clock_stamp(at))


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(_rows().alias(name))


def rows_per_key(df: DataFrame, key: str, name: str = "row_count") -> DataFrame:
    return _grouped(df, key, {name: _rows()})


def total(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.agg(F.sum(column).alias(name))


def distinct_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number of different values; duplicates are dropped in each task before the shuffle."""
    return df.agg(F.count_distinct(key).alias(name))
