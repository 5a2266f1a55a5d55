"""Mergeable aggregates: partial states of a group's counts, sums and squared deviations.

States of parts of a table (a day, a file, a batch) are stored once and merged for any selection of
parts, so gold follows a changed part without a look at the others. Variances merge by the rule for
combined samples: deviations inside the parts plus those of the parts' means, which keeps its
precision where sums of squares would lose theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.contracts import Column as Field


def state_fields(values: Sequence[str]) -> tuple[Field, ...]:
    """Columns of a state besides its keys."""
    fields = [Field("row_count", "bigint")]
    for v in values:
        fields += [Field(f"{v}_n", "bigint"), Field(f"{v}_sum", "double"), Field(f"{v}_m2", "double")]
    return tuple(fields)


def partial_states(df: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """One state per group; NULL values count as rows but take no part in sums and deviations."""
    parts = [F.count(F.lit(1)).alias("row_count")]
    for v in values:
        known = F.count(v)
        parts += [
            known.alias(f"{v}_n"),
            F.coalesce(F.sum(v), F.lit(0.0)).cast("double").alias(f"{v}_sum"),
            F.coalesce(F.var_pop(v) * known, F.lit(0.0)).alias(f"{v}_m2"),
        ]
    return df.groupBy(*keys).agg(*parts)


def merge_states(states: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """States of the coarser groups ``keys``. States are few, so means are found by a window first."""
    group = Window.partitionBy(*(keys or [F.lit(0)]))
    for v in values:
        total = F.sum(f"{v}_sum").over(group) / F.nullif(F.sum(f"{v}_n").over(group), F.lit(0))
        own = F.col(f"{v}_sum") / F.nullif(F.col(f"{v}_n"), F.lit(0))
        apart = F.coalesce(F.col(f"{v}_n") * (own - total) * (own - total), F.lit(0.0))
        states = states.withColumn(f"_{v}_m2", F.col(f"{v}_m2") + apart)
    merged = [F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count")]
    for v in values:
        merged += [
            F.coalesce(F.sum(f"{v}_n"), F.lit(0)).alias(f"{v}_n"),
            F.coalesce(F.sum(f"{v}_sum"), F.lit(0.0)).alias(f"{v}_sum"),
            F.coalesce(F.sum(f"_{v}_m2"), F.lit(0.0)).alias(f"{v}_m2"),
        ]
    return states.groupBy(*keys).agg(*merged)


def state_mean(value: str) -> Column:
    """NULL without a known value."""
    return F.col(f"{value}_sum") / F.nullif(F.col(f"{value}_n"), F.lit(0))


def state_sum(value: str) -> Column:
    return F.when(F.col(f"{value}_n") > 0, F.col(f"{value}_sum"))


def state_deviation(value: str) -> Column:
    """Sample deviation; NULL for fewer than two values."""
    n = F.col(f"{value}_n")
    return F.sqrt(F.when(n > 1, F.col(f"{value}_m2") / (n - 1)))
