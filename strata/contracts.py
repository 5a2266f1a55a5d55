"""Columns and types each dataset carries, and the check that a frame has them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from strata.errors import SchemaMismatch


class Column(NamedTuple):
    name: str
    type: str


class Conform(NamedTuple):
    """One silver column: where it comes from, what it becomes, what it is called."""

    source: str
    type: str
    name: str


# The column names, types and order that results must carry.

FLIGHTS_STAGING = (
    Column("OP_UNIQUE_CARRIER", "string"),
    Column("ORIGIN", "string"),
    Column("DEST", "string"),
    Column("DEP_DELAY_NEW", "double"),
    Column("ARR_DELAY_NEW", "double"),
    Column("CANCELLED", "double"),
    Column("DISTANCE", "double"),
)

FLIGHTS_BRONZE = (
    Column("op_unique_carrier", "string"),
    Column("origin", "string"),
    Column("dest", "string"),
    Column("dep_delay_new", "double"),
    Column("arr_delay_new", "double"),
    Column("cancelled", "double"),
    Column("distance", "double"),
    Column("source_file", "string"),
    Column("ingest_ts", "timestamp"),
)

# What a source file had, before any typing.
FLIGHTS_RAW = (
    Column("op_unique_carrier", "string"),
    Column("origin", "string"),
    Column("dest", "string"),
    Column("dep_delay_new", "string"),
    Column("arr_delay_new", "string"),
    Column("cancelled", "string"),
    Column("distance", "string"),
    Column("corrupt_record", "string"),
    Column("source_file", "string"),
    Column("ingest_ts", "timestamp"),
)

FLIGHTS_CONFORM = (
    Conform("op_unique_carrier", "string", "carrier"),
    Conform("origin", "string", "origin"),
    Conform("dest", "string", "dest"),
    Conform("dep_delay_new", "double", "dep_delay_minutes"),
    Conform("arr_delay_new", "double", "arr_delay_minutes"),
    Conform("cancelled", "double", "cancelled_flag"),
    Conform("distance", "double", "distance_miles"),
    Conform("source_file", "string", "source_file"),
    Conform("ingest_ts", "timestamp", "ingest_ts"),
)

EVENTS_BRONZE = (
    Column("event_id", "bigint"),
    Column("ts", "timestamp"),
    Column("value", "double"),
    Column("dt", "string"),
)

EVENTS_CONFORM = (
    Conform("event_id", "bigint", "event_id"),
    Conform("dt", "date", "event_date"),
)

EVENTS_SILVER = (
    Column("event_id", "bigint"),
    Column("event_date", "date"),
    Column("ingest_ts", "timestamp"),
)

DAILY_EVENT_COUNTS = (
    Column("event_date", "date"),
    Column("event_count", "bigint"),
    Column("load_ts", "timestamp"),
)

CARRIER_SUMMARY = (
    Column("carrier", "string"),
    Column("flight_count", "bigint"),
    Column("avg_dep_delay_minutes", "double"),
    Column("avg_arr_delay_minutes", "double"),
    Column("cancelled_count", "double"),
    Column("avg_distance_miles", "double"),
    Column("load_ts", "timestamp"),
)

CARRIER_DELAY_SPREAD = (
    Column("carrier", "string"),
    Column("flight_count", "bigint"),
    Column("avg_arr_delay", "double"),
    Column("avg_dep_delay", "double"),
    Column("std_arr_delay", "double"),
    Column("std_dep_delay", "double"),
    Column("built_at", "timestamp_ntz"),
)

TOPIC_MESSAGES = (
    Column("topic", "string"),
    Column("partition", "int"),
    Column("offset", "bigint"),
    Column("key", "string"),
    Column("value", "string"),
    Column("timestamp", "timestamp"),
)

# End of fixed values.

THROUGHPUT = (
    Column("window_start", "timestamp"),
    Column("window_end", "timestamp"),
    Column("event_date", "date"),
    Column("event_count", "bigint"),
    Column("kind", "string"),
)


def conformed(fields: Sequence[Conform]) -> tuple[Column, ...]:
    return tuple(Column(f.name, f.type) for f in fields)


FLIGHTS_SILVER = conformed(FLIGHTS_CONFORM)


def ddl(columns: Sequence[Column]) -> str:
    """The contract as a schema string for readers and DDL."""
    return ", ".join(f"`{c.name}` {c.type}" for c in columns)


def check_schema(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Return ``df`` unchanged, or say which columns are missing, extra or of another type.

    Column order is free: a partition column always comes back last from a scan.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = dict(columns)
    problems = [f"missing {n} {t}" for n, t in wanted.items() if n not in found]
    problems += [f"extra {n} {t}" for n, t in found.items() if n not in wanted]
    problems += [
        f"{n} is {found[n]}, not {t}" for n, t in wanted.items() if n in found and found[n] != t
    ]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
