"""Row-level reconciliation: are the rows of two layers the same, and if not, which differ?

Each side is read once into digests per partition and bucket: rows, and sum and xor of a 64-bit hash
a row. They do not depend on the order of rows, but a lost, doubled or changed row alters them, and
they combine inside tasks. Only rows of buckets that differ are read again and counted one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strata.errors import ReconciliationFailed, SchemaMismatch
from strata.workspace import scratch_folder

BUCKETS = 256

#: Folder keys named in a filter; more are left to the join.
LISTED = 1000


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row. Spark's hash passes over NULLs, so which columns are NULL counts too."""
    values = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*values, *[v.isNull() for v in values])


def _bucket(identity: Sequence[str], buckets: int) -> Column:
    return F.pmod(row_hash(identity), F.lit(buckets)).cast("int")


def row_digests(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    identity: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per value of ``by`` and bucket: ``row_count``, ``hash_sum`` and ``hash_xor``.

    Rows fall into buckets by ``identity`` (all ``columns`` unless given), so that both versions of a
    changed row meet in one bucket. Digests of parts of a table add up to those of the whole
    (``merge_digests``), and can be stored beside it.
    """
    rows = df.select(
        *by, _bucket(identity or columns, buckets).alias("bucket"), row_hash(columns).alias("_hash")
    )
    # A sum of many 64-bit numbers does not fit 64 bits.
    return rows.groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col("_hash").cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor("_hash").alias("hash_xor"),
    )


def merge_digests(digests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return digests.groupBy(*by, "bucket").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("hash_sum").cast("decimal(30,0)").alias("hash_sum"),
        F.bit_xor("hash_xor").alias("hash_xor"),
    )


def differing_buckets(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Buckets whose digests differ, with the rows of either side. One shuffle, no join."""

    def side(digests: DataFrame, sign: int) -> DataFrame:
        return digests.select(
            *by,
            "bucket",
            F.col("row_count").alias("left_rows") if sign > 0 else F.lit(0).alias("left_rows"),
            F.col("row_count").alias("right_rows") if sign < 0 else F.lit(0).alias("right_rows"),
            (F.col("hash_sum") * sign).cast("decimal(38,0)").alias("_sum"),
            F.col("hash_xor").alias("_xor"),
        )

    both = side(left, 1).unionByName(side(right, -1))
    found = both.groupBy(*by, "bucket").agg(
        F.sum("left_rows").alias("left_rows"),
        F.sum("right_rows").alias("right_rows"),
        F.sum("_sum").alias("_sum"),
        F.bit_xor("_xor").alias("_xor"),
    )
    apart = (F.col("left_rows") != F.col("right_rows")) | (F.col("_sum") != 0) | (F.col("_xor") != 0)
    return found.where(apart).drop("_sum", "_xor")


def _same_columns(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> None:
    for c in columns:
        kinds = [df.select(f"`{c}`").schema[0].dataType.simpleString() for df in (left, right)]
        if kinds[0] != kinds[1]:
            raise SchemaMismatch(f"{c} is {kinds[0]} on one side and {kinds[1]} on the other")


def _listed(values: Sequence[Row], by: Sequence[str]) -> Column:
    """The filter that keeps these values of ``by``; none if they are too many to list."""
    if not by or len(values) > LISTED:
        return F.lit(True)

    def among(c: str) -> Column:
        known = [r[c] for r in values if r[c] is not None]
        found = F.col(f"`{c}`").isin(known) if known else F.lit(False)
        return found | F.col(f"`{c}`").isNull() if len(known) < len(values) else found

    return reduce(lambda a, b: a & b, [among(c) for c in by])


def differing_rows(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    identity: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows (``columns``, which should include ``by``) that one side has more often than the other,
    with ``bucket``, ``left_rows`` and ``right_rows``.

    Both sides are read once for their digests, and again only where these differ: up to ``LISTED``
    values of ``by`` become filters, so with a folder key Spark does not open the other folders.
    """
    _same_columns(left, right, [*dict.fromkeys([*columns, *by])])
    apart = differing_buckets(
        row_digests(left, columns, by, identity, buckets),
        row_digests(right, columns, by, identity, buckets),
        by,
    ).select(*by, "bucket")
    path = f"{scratch_folder(left.sparkSession, 'differing')}/buckets"
    apart.write.parquet(path)
    apart = left.sparkSession.read.schema(apart.schema).parquet(path)
    where = _listed(apart.select(*by).distinct().limit(LISTED + 1).collect() if by else [], by)

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        keys = [*dict.fromkeys([*columns, *by])]
        rows = df.where(where).select(*keys, _bucket(identity or columns, buckets).alias("bucket"))
        match = [rows[c].eqNullSafe(apart[c]) for c in by]
        met = rows.join(apart, [*match, rows["bucket"] == apart["bucket"]], "left_semi")
        return met.select(*keys, "bucket", F.lit(1).alias(own), F.lit(0).alias(other))

    both = side(left, "left_rows", "right_rows").unionByName(side(right, "right_rows", "left_rows"))
    counted = both.groupBy(*[c for c in both.columns if c not in ("left_rows", "right_rows")])
    counted = counted.agg(F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"))
    return counted.where("left_rows <> right_rows")


def require_same_rows(
    left: DataFrame, right: DataFrame, columns: Sequence[str], **options
) -> None:
    """Stop the flow unless both sides have the same rows; the message shows the first few."""
    found = differing_rows(left, right, columns, **options)
    first = found.limit(5).collect()
    if first:
        raise ReconciliationFailed(f"rows differ, among them {[r.asDict() for r in first]}")
