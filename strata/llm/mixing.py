"""Mixing sources to target weights by Poisson replication.

A source of ``n`` rows that should give a share ``w`` of ``total`` rows repeats each row
``total * w / n`` times on average. Every row's count is the inverse of the Poisson distribution
with that mean at a number hashed from seed and row, so a rerun or a lost executor gives the same
counts. Copies are then dealt out and sorted by another hash. Everything is a DataFrame expression.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, partitions

#: A larger mean is drawn as the sum of several Poisson draws of at most this mean.
MEAN_PER_DRAW = 16.0


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the keys joined by ``:``; NULL is empty."""
    text = F.concat_ws(":", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(2**52)


def distribution(mean: Column) -> Column:
    """Cumulated Poisson probabilities, up to where they no longer grow in 52 bits."""
    upto = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    zero = F.struct(
        F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")
    )
    return F.aggregate(
        F.sequence(F.lit(1), upto),
        zero,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.array_append(a["cdf"], F.element_at(a["cdf"], -1) + a["p"] * mean / k).alias("cdf"),
        ),
        lambda a: a["cdf"],
    )


def _class(source: Column, names: list[str]) -> Column:
    """Number of a source in ``names``; all others, NULL among them, are one class, -1."""
    if not names:
        return F.lit(-1)
    numbers = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    return F.coalesce(numbers[source], F.lit(-1))


def rates(
    df: DataFrame,
    weights: Mapping[str, float],
    source_col: str,
    total: int | None = None,
    rest_weight: float = 0.0,
) -> DataFrame:
    """``mix_class``, ``mean`` and ``draws`` of every source that has rows, and of the rest.

    Weights are shares of the sum of those present; ``total`` is the number of rows aimed at, all
    rows of ``df`` unless given. One row per weight and one for the rest: bounded by the parameter.
    """
    names = sorted(weights)
    class_ = _class(F.col(source_col), names).alias("c")
    present = {r.c: r.n for r in df.groupBy(class_).agg(F.count("*").alias("n")).collect()}
    share = {c: rest_weight if c < 0 else weights[names[c]] for c in present}
    aim = sum(present.values()) if total is None else total
    rows = []
    for c, n in sorted(present.items()):
        if share[c]:
            mean = aim * share[c] / sum(share.values()) / n
            draws = max(1, math.ceil(mean / MEAN_PER_DRAW))
            rows.append((c, mean, draws, mean / draws))
    out = df.sparkSession.createDataFrame(
        rows, "mix_class int, mean double, draws int, per_draw double"
    )
    return out.withColumn("cdf", distribution(F.col("per_draw")))


def mix(
    df: DataFrame,
    weights: Mapping[str, float],
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = 42,
    total: int | None = None,
    rest_weight: float = 0.0,
    copy_col: str | None = None,
    order_col: str | None = None,
) -> DataFrame:
    """Rows of ``df`` repeated to the target weights, in a global random order.

    Sources without a weight, NULL among them, share ``rest_weight``. NULL ids count as the empty id; rows with
    the same id and source get the same count. ``copy_col`` and ``order_col``, if named, keep the
    number of the copy (from 0) and the hash sorted by; underscores are added to a name that ``df``
    has. An empty table stays empty.
    """
    named = [c for c in (copy_col, order_col) if c]
    source, mean, draws, per, cdf, count, copy, key, first, *named = fresh(
        df, "_source", "_mean", "_draws", "_per", "_cdf", "_count", "_copy", "_key", "_first", *named
    )
    rate = rates(df, weights, source_col, total, rest_weight).toDF(source, mean, draws, per, cdf)
    class_ = _class(df[source_col], sorted(weights))
    rows = df.join(F.broadcast(rate), class_ == rate[source])
    seeded, id_ = F.lit(str(seed)), df[id_col]

    def drawn(i: Column) -> Column:
        return F.size(
            F.filter(F.col(cdf), lambda c: c <= uniform(seeded, id_, i))
        )

    rows = rows.withColumn(first, uniform(seeded, id_, F.lit(0)))
    single = F.size(F.filter(F.col(cdf), lambda c: c <= F.col(first)))
    several = F.aggregate(
        F.sequence(F.lit(0), F.col(draws) - 1), F.lit(0), lambda a, i: a + drawn(i)
    )
    rows = rows.withColumn(count, F.when(F.col(draws) == 1, single).otherwise(several))
    rows = rows.where(F.col(count) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    )
    rows = rows.withColumn(
        key,
        F.md5(
            F.concat_ws(
                ":",
                F.lit(f"order{seed}"),
                F.coalesce(id_.cast("string"), F.lit("")),
                F.col(copy).cast("string"),
            )
        ),
    )
    rows = rows.repartitionByRange(partitions(df.sparkSession), key).sortWithinPartitions(key)
    extra = [F.col(copy).cast("long")] if copy_col else []
    extra += [F.col(key)] if order_col else []
    out = [c.alias(name) for c, name in zip(extra, named, strict=True)]
    return rows.select(*[df[c] for c in df.columns], *out)
