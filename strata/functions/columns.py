"""Column helpers. Everything here is a built-in expression and works on streams too."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.errors import SchemaMismatch


def snake_case(name: str) -> str:
    """``OP_UNIQUE_CARRIER``, ``opUniqueCarrier`` and ``Op Unique-Carrier`` all give one name."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.strip())
    return re.sub(r"[^0-9A-Za-z]+", "_", spaced).strip("_").lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    clashes = [n for n, times in Counter(names).items() if times > 1 or not n]
    if clashes:
        raise SchemaMismatch(f"column names clash after renaming: {clashes}")
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in zip(df.columns, names)])


def with_names(
    df: DataFrame, names: Mapping[str, str], constants: Mapping[str, object] | None = None
) -> DataFrame:
    """The columns of ``names`` (old to new) in its order, then constants; all others are left out."""
    given = dict(constants or {})
    missing = [old for old in names if old not in df.columns]
    clashes = [n for n, times in Counter([*names.values(), *given]).items() if times > 1]
    if missing or clashes:
        raise SchemaMismatch(f"no columns {missing}; names that clash {clashes}")
    renamed = [F.col(f"`{old}`").alias(new) for old, new in names.items()]
    return df.select(*renamed, *[F.lit(value).alias(name) for name, value in given.items()])


def typed(column: Column, type_name: str) -> Column:
    """Cast that gives NULL on a value that does not fit, also with ANSI mode on."""
    return column.try_cast(type_name)


def rejected(column: Column, type_name: str) -> Column:
    """1 where a value is present but does not fit the type, else 0."""
    return (column.isNotNull() & typed(column, type_name).isNull()).cast("int")


def stamp(at: str | None = None) -> Column:
    """Load time; ``at`` fixes it for reproducible runs."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def wall_clock_stamp(at: str | None = None) -> Column:
    """Load time without a zone."""
    return stamp(at).cast("timestamp_ntz")


def file_name() -> Column:
    """File a row was read from: right per row when a source has many files."""
    return F.col("_metadata.file_name")


def with_provenance(df: DataFrame, source: str | None = None, at: str | None = None) -> DataFrame:
    """Add ``source_file`` (a label, or each row's own file) and ``ingest_ts``."""
    origin = file_name() if source is None else F.lit(source)
    return df.select("*", origin.alias("source_file"), stamp(at).alias("ingest_ts"))


def utc_date(column: Column) -> Column:
    """UTC calendar day of an instant, whatever the session time zone is."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(column) / 86400).cast("int"))
