"""Profiles of parts of a table that merge: counts, bounds, distinct values, quantiles, frequent values.

A part's profile is a few kilobytes per column, whatever its rows. It is stored once and merged for
any selection of parts, without a look at the data. Estimates keep the sketches' bounds however
often they are merged: distinct values within about 1.6 % (one standard error, ``lg_k`` 12), ranks of
quantiles within about 1.7 % (``k`` 200), a frequent value's count within ``TOP_ERROR`` times the rows.
A value that is more frequent than twice that is listed; where none is, ``top_values`` is empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K, K, TRACKED = 12, 200, 1024
#: The sketch keeps a table of the next power of two above ``TRACKED`` / 0.75 and errs by 3.5 parts of it.
TOP_ERROR = 3.5 / 2048


def _column_profile(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    text = value.cast("string")
    number = isinstance(kind, T.NumericType)
    double = value.cast("double") if number else F.lit(None).cast("double")
    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(kind.simpleString()).alias("data_type"),
        F.count(F.lit(1)).alias("row_count"),
        F.count(value).alias("non_null_count"),
        F.min(double).alias("least"),
        F.max(double).alias("most"),
        F.min(text).alias("first_text"),
        F.max(text).alias("last_text"),
        F.hll_sketch_agg(text, F.lit(LG_K)).alias("values"),
        F.kll_sketch_agg_double(double, F.lit(K)).alias("quantiles"),
        F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias("frequent"),
    )


def profile_parts(
    df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per part (values of ``by``) and column; all columns are profiled in one scan.

    Values are compared as text; bounds and quantiles are for numbers, as doubles. NULL counts as a
    row and nothing else. Sketches combine inside tasks before the shuffle.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    picked = [c for c in (columns or df.columns) if c not in by]
    parts = [_column_profile(c, kinds[c]).alias(f"_p{i}") for i, c in enumerate(picked)]
    rows = df.groupBy(*by).agg(*parts)
    listed = F.explode(F.array(*[F.col(f"_p{i}") for i in range(len(picked))])).alias("p")
    return rows.select(*by, listed).select(*by, "p.*")


def merge_profiles(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Profiles of coarser parts, in the same columns: over all parts, or per value of ``by``."""
    return parts.groupBy(*by, "column_name", "data_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("non_null_count").alias("non_null_count"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
        F.min("first_text").alias("first_text"),
        F.max("last_text").alias("last_text"),
        F.hll_union_agg("values").alias("values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(TRACKED)).alias("frequent"),
    )


def read_profile(
    profiles: DataFrame,
    by: Sequence[str] = (),
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
    top: int = 5,
) -> DataFrame:
    """What the sketches say: ``distinct_count``, ``quantile_values`` (NULL unless numbers were
    seen) and ``top_values`` (value and count, most frequent first; none frequent: empty)."""
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    seen = F.col("least").isNotNull()
    return profiles.select(
        *by,
        "column_name",
        "data_type",
        "row_count",
        "non_null_count",
        "least",
        "most",
        "first_text",
        "last_text",
        F.hll_sketch_estimate("values").alias("distinct_count"),
        F.when(seen, F.kll_sketch_get_quantile_double("quantiles", asked)).alias("quantile_values"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top)).alias("top_values"),
    )
