"""Bronze to silver: rename, type, order. No row is dropped and no NULL is filled."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.contracts import EVENTS_CONFORM, FLIGHTS_CONFORM, Conform
from strata.functions import rejected, stamp, typed

REJECTS = "_rejects"


def conform(df: DataFrame, fields: Sequence[Conform], rejects: str | None = None) -> DataFrame:
    """One projection to the silver columns. Works on batches and streams.

    A value that does not fit its type becomes NULL; ``rejects`` names a column that counts,
    per row, how often that happened.
    """
    columns = [typed(F.col(f.source), f.type).alias(f.name) for f in fields]
    if rejects:
        faults = [rejected(F.col(f.source), f.type) for f in fields]
        columns.append(reduce(add, faults).alias(rejects))
    return df.select(*columns)


def faults(fields: Sequence[Conform]) -> Column:
    """Per row the silver names of the values that do not fit, in order; empty for a sound row."""
    found = [F.when(rejected(F.col(f.source), f.type) == 1, F.lit(f.name)) for f in fields]
    return F.filter(F.array(*found), lambda name: name.isNotNull())


def conform_flights(df: DataFrame, rejects: str | None = None) -> DataFrame:
    return conform(df, FLIGHTS_CONFORM, rejects)


def conform_events(df: DataFrame, at: str | None = None, rejects: str | None = None) -> DataFrame:
    return conform(df, EVENTS_CONFORM, rejects).withColumn("ingest_ts", stamp(at))
