"""What several operators share: word and row helpers, and tables written to cut lineage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.workspace import scratch_folder

#: Words are runs of anything else than space, tab, LF, VT, FF and CR.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a written table: lineage ends here, and a lost executor costs a reread."""
    path = f"{scratch_folder(df.sparkSession, label)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def words(text: Column) -> Column:
    """The words of a text in order; NULL gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), lambda w: w != "")


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, order: list[Column], number_col: str, label: str) -> DataFrame:
    """``df``, written, with the place of each row in ``order`` from 0 as ``number_col``.

    Rows are dealt by range and sorted there; the ranges' row counts (one number a range, all that
    is broadcast) give each its offset, so no task sees more than a range.
    """
    place, part, before, n = fresh(df, "_place", "_part", "_before", "_n")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = settle(ranged.withColumn(place, F.monotonically_increasing_id()), label)
    rows = rows.withColumn(part, F.shiftright(place, 33).cast("int"))
    counts = rows.groupBy(part).agg(F.count("*").alias(n))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    own = F.col(place).bitwiseAND(F.lit(2**33 - 1))
    joined = rows.join(F.broadcast(offsets), part)
    return joined.select(*df.columns, (F.col(before) + own).alias(number_col))
