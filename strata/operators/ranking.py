"""Order-based reports over gold rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Distinct texts looked at per cut.
SAMPLE = 20


def top_by(df: DataFrame, column: str, tie_break: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest ``column``; every task keeps only ``n`` rows."""
    return df.orderBy(F.col(column).desc_nulls_last(), F.col(tie_break).asc()).limit(n)


def rank_by(df: DataFrame, names: Mapping[str, str], ranges: int | None = None) -> DataFrame:
    """Add, per ``{column: name}``, ``rank() OVER (ORDER BY column DESC NULLS LAST)``.

    An ordering window without a partition would pull the whole frame into one task. Instead:
    count rows per distinct value, cut the values into ``ranges`` ranges of about equal size (as many
    as shuffle partitions, unless given), rank inside each range, and add the rows of all higher
    ranges. Text is cut on a bounded sample of its distinct values. Equal values are one row by
    then, so a value that a third of the rows share is no burden. ``df`` is read several times
    and should be a stored table.
    """
    ranges = ranges or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # At most ranges - 1 numbers a column come to the driver, as fixed cuts: computed twice inside
    # the plan they could differ and tear a range apart.
    cuts = _cuts(df, list(names), ranges)
    ranked = df
    for column, name in names.items():
        ranks = _ranks(df, column, name, cuts[column])
        match = ranked[column].eqNullSafe(ranks["_value"])
        ranked = ranked.join(ranks, match, "left").drop("_value")
    return ranked


def _ranks(df: DataFrame, column: str, name: str, cuts: Sequence[object]) -> DataFrame:
    values = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))

    ranged = values.withColumn("_range", _range_of(F.col("_value"), cuts))

    # One row per range, so this window over all of them is at most ranges + 1 rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum("_rows").alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_range")
        .orderBy(F.col("_value").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumn("_above", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_range")
        .select("_value", (F.col("_offset") + F.col("_above") + 1).alias(name))
    )


def _cuts(df: DataFrame, columns: Sequence[str], ranges: int) -> dict[str, list[object]]:
    """Cut values of each column; all columns of numbers and times share one read of ``df``."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    cuts: dict[str, list[object]] = {}
    for c in columns:
        if kinds[c] == "boolean":
            cuts[c] = [True]
        elif kinds[c] == "string":
            known = df.select(F.col(c).alias("_value")).where(F.col(c).isNotNull()).distinct()
            picked = known.orderBy(F.xxhash64("_value"), "_value").limit(SAMPLE * ranges)
            texts = sorted((r[0] for r in picked.collect()), key=str.encode)
            cuts[c] = texts[SAMPLE::SAMPLE][: ranges - 1]
    rest = [c for c in columns if c not in cuts]
    if rest:
        steps = [i / ranges for i in range(1, ranges)]
        found = df.agg(*[F.percentile_approx(c, steps) for c in rest]).first()
        cuts |= {c: sorted(set(values or [])) for c, values in zip(rest, found, strict=True)}
    return cuts


def _range_of(value: Column, cuts: Sequence[object]) -> Column:
    """Number of the range, from 0 for the highest values; NULL values come last.

    Nested halving: a value meets log2(cuts) comparisons.
    """

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(len(cuts) - low)
        middle = (low + high) // 2
        return F.when(value < F.lit(cuts[middle]), halve(low, middle)).otherwise(
            halve(middle + 1, high)
        )

    return F.when(value.isNull(), F.lit(len(cuts) + 1)).otherwise(halve(0, len(cuts)))
