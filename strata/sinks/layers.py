"""Parquet writes that count what they write."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.errors import ForeignRows, InvalidName, SelfOverwrite


@dataclass(frozen=True)
class JobResult:
    path: str
    rows: int
    metrics: dict[str, object] = field(default_factory=dict)


def _normal(path: str) -> str:
    """One spelling per place: no ``file:`` scheme, no doubled slashes, no ``..``."""
    scheme, _, rest = re.sub(r"^file:/*", "/", path).rpartition("://")
    return f"{scheme}:{posixpath.normpath(rest)}/"


def refuse_self_overwrite(target: str, reads: Sequence[str]) -> None:
    """Spark deletes the target before it reads, so an overlap would lose the data."""
    goal = _normal(target)
    for source in map(_normal, reads):
        if source.startswith(goal) or goal.startswith(source):
            raise SelfOverwrite(f"{target} overlaps {source}, which the job reads")


def read_paths(df: DataFrame) -> list[str]:
    """Root folders of the files that ``df`` reads, from its analysed plan; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    paths: list[str] = []
    for i in range(leaves.length()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                paths += [roots.apply(k).toString() for k in range(roots.length())]
    return paths


def write_layer(
    df: DataFrame,
    path: str,
    *,
    reads: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    rebalance: bool = True,
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> JobResult:
    """Write Parquet and count its rows (and ``metrics``) in the same pass.

    ``reads``       more paths than those in the frame's plan that an overwrite must not touch.
    ``partition_by``  folder keys. Rows are rebalanced on them first, so a key gets few large
                    files and AQE splits a key that is too big for one task; turn ``rebalance``
                    off when the rows already lie together.
    ``dynamic``     replace only the partitions that occur in ``df``.
    ``metrics``     aggregates over the rows written; columns in ``drop`` may feed them and are
                    not written.

    The counters sit above the last shuffle. There Spark adds each task's share once, also when
    a lost executor makes it run map tasks again.
    """
    if mode == "overwrite":
        refuse_self_overwrite(path, [*reads, *read_paths(df)])
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    seen = Observation()
    extra = [aggregate.alias(name) for name, aggregate in (metrics or {}).items()]
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra).drop(*drop)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    found = dict(seen.get)
    return JobResult(path, found.pop("rows"), found)


def land_day(
    df: DataFrame,
    root: str,
    day: str,
    key: str = "dt",
    reads: Sequence[str] = (),
    skip_others: bool = False,
) -> JobResult:
    """Replace one day's landing folder ``<key>=<day>/``; other days stay as they are.

    Rows of other days (or none) are refused before anything is written; with ``skip_others`` they
    are left out and counted as the metric ``others``. The key also stays in the files, so the
    folder can be registered as a table of its own.
    """
    try:
        date.fromisoformat(day)
    except ValueError:
        raise InvalidName(f"not a date: {day!r}") from None
    own = F.col(key).eqNullSafe(day)
    if not skip_others and not df.where(~own).isEmpty():
        raise ForeignRows(f"not all rows have {key} {day}")
    seen = Observation()
    rows = df.observe(seen, F.count_if(~own).alias("others")).where(own)
    result = write_layer(rows, f"{root.rstrip('/')}/{key}={day}", reads=reads)
    return JobResult(result.path, result.rows, result.metrics | seen.get)
