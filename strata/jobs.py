"""Jobs to hand to spark-submit: ``spark-submit --py-files strata.zip jobs.py --root ... count ...``.

Table commands see the session's catalog, so give the session a lasting one (a Hive metastore)
when one command is to find what another registered.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame, SparkSession

from strata import catalog
from strata.contracts import THROUGHPUT, Column
from strata.errors import StrataError
from strata.lake import LAYERS, DatasetRef, Lake
from strata.operators import column_drift, describe, file_schemas, row_count
from strata.plans import (
    build_all,
    build_gold,
    build_model,
    build_silver,
    ingest_new,
    ingest_text,
    list_models,
    parse_mapping,
    run_events,
    run_flights,
)
from strata.plans.flights import ingest_csv
from strata.session import build_session, object_store_conf
from strata.sinks import compact, produce
from strata.sinks.compaction import TARGET
from strata.sources import (
    consume,
    list_files,
    generate_events,
    read_all_topics,
    read_layer,
    read_topic,
    topic_summary,
)

from strata.streaming import (
    corrected_throughput,
    reject_report,
    run_available,
    run_throughput,
    stream_files,
    stream_to_bronze,
    to_parquet,
    to_silver_or_quarantine,
)


def _ref(a: argparse.Namespace) -> DatasetRef:
    return DatasetRef(a.layer, a.project, a.name)


def _register(spark: SparkSession, lake: Lake, a: argparse.Namespace) -> str:
    ref = _ref(a)
    if a.partition_by:
        return catalog.register_partitioned_table(spark, lake, ref, a.partition_by)
    return catalog.register_table(spark, lake, ref, day=a.day, drop_first=not a.no_drop)


def _table(spark: SparkSession, lake: Lake, a: argparse.Namespace) -> DataFrame:
    return spark.table(lake.table(_ref(a)))


def _stream(spark: SparkSession, lake: Lake, a: argparse.Namespace) -> str:
    """What a topic's log holds now to bronze; the next run goes on from there."""
    target = lake.path(DatasetRef("bronze", a.project, a.name))
    bronze = stream_to_bronze(read_topic(spark, lake, a.topic, stream=True), a.topic)
    run_available(to_parquet(bronze, target, lake.checkpoint_path(f"{a.project}_{a.name}")))
    return target


def _gate(spark: SparkSession, lake: Lake, a: argparse.Namespace) -> DataFrame:
    """New bronze files to silver, rows that do not fit to quarantine; prints the reject report."""
    ref = DatasetRef("bronze", a.project, a.name)
    found = read_layer(spark, lake.path(ref)).schema
    columns = [Column(f.name, f.dataType.simpleString()) for f in found]
    bronze = stream_files(spark, lake.path(ref), columns, a.files_per_batch)
    silver, aside = lake.path(ref.at("silver")), lake.quarantine_path(ref)
    checkpoint = lake.checkpoint_path(f"{a.project}_{a.name}_gate")
    fields = parse_mapping(a.column)
    run_available(to_silver_or_quarantine(bronze, fields, silver, aside, checkpoint))
    return reject_report(read_layer(spark, aside))


def _throughput(spark: SparkSession, lake: Lake, a: argparse.Namespace) -> DataFrame:
    """What a topic's log holds now to windows and corrections; prints the counts so far."""
    target = lake.path(DatasetRef("gold", a.project, a.name))
    log = read_topic(spark, lake, a.topic, stream=True)
    checkpoint = lake.checkpoint_path(f"{a.project}_{a.name}_throughput")
    run_throughput(log, target, checkpoint, time="timestamp", late_by=a.late_by, every=a.every)
    return corrected_throughput(read_layer(spark, target, THROUGHPUT)).orderBy("window_start")


_COMMANDS = {
    "flights": lambda s, lake, a: run_flights(
        s, lake, a.source, resume=a.resume, check_rows=a.check_rows
    ),
    "ingest-new": lambda s, lake, a: ingest_new(
        s, lake, DatasetRef("bronze", a.project, a.name), a.source
    ),
    "stream-silver": _gate,
    "stream-throughput": _throughput,
    "compact": lambda s, lake, a: compact(s, lake.path(_ref(a)), a.key, a.target_bytes),
    "drift": lambda s, lake, a: column_drift(file_schemas(s, lake.path(_ref(a)))),
    "events": lambda s, lake, a: run_events(s, lake, generate_events(s, a.n, a.day)),
    "ingest": lambda s, lake, a: ingest_csv(
        s, lake, DatasetRef("bronze", a.project, a.name), a.source
    ),
    "register": _register,
    "sync": lambda s, lake, a: catalog.sync_partitions(s, lake, _ref(a)),
    "drop": lambda s, lake, a: catalog.drop_table(s, lake, _ref(a)),
    "tables": lambda s, lake, a: catalog.list_tables(s, lake, a.layer),
    "count": lambda s, lake, a: row_count(_table(s, lake, a)),
    "sample": lambda s, lake, a: catalog.sample(s, lake, _ref(a), a.n),
    "describe": lambda s, lake, a: describe(_table(s, lake, a)),
    "sql": lambda s, lake, a: catalog.run_sql(s, a.text),
    "models": lambda s, lake, a: list_models(a.project),
    "build": lambda s, lake, a: build_model(s, lake, a.project, a.name),
    "build-all": lambda s, lake, a: build_all(s, lake, a.project),
    "files": lambda s, lake, a: list_files(s, f"{lake.root.rstrip('/')}/{a.prefix}"),
    "ingest-text": lambda s, lake, a: ingest_text(
        s, lake, DatasetRef("bronze", a.project, a.name), a.source, multi_line=a.multi_line
    ),
    "silver": lambda s, lake, a: build_silver(
        s, lake, DatasetRef("silver", a.project, a.name), parse_mapping(a.column)
    ),
    "gold": lambda s, lake, a: build_gold(
        s, lake, DatasetRef("gold", a.project, a.name), a.select
    ),
    "stream-topic": lambda s, lake, a: _stream(s, lake, a),
    "topics": lambda s, lake, a: topic_summary(read_all_topics(s, lake)),
    "produce": lambda s, lake, a: produce(s, lake, a.topic, a.n, a.prefix),
    "consume": lambda s, lake, a: consume(read_topic(s, lake, a.topic), a.n),
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__)
    parser.add_argument("--root", required=True, help="root folder of the lake")
    parser.add_argument("--endpoint", help="object store; keys come from the environment")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, *arguments: str, **options: dict) -> None:
        sub = commands.add_parser(name)
        for argument in arguments:
            choices = LAYERS if argument == "layer" else None
            sub.add_argument(argument, choices=choices)
        for option, settings in options.items():
            sub.add_argument(f"--{option.replace('_', '-')}", **settings)

    project = {"default": "demo"}
    ten = {"type": int, "default": 10}
    out = {"out": {}, "format": {"choices": ("parquet", "csv"), "default": "parquet"}}
    yes = {"action": "store_true"}
    add("flights", "source", resume=yes, check_rows=yes)
    add("ingest-new", "name", "source", project=project)
    day = {"default": "1 day"}
    add("stream-throughput", "topic", "name", project=project, late_by=day, every=day, **out)
    size = {"type": int, "default": TARGET}
    add("compact", "layer", "name", project=project, key={"required": True}, target_bytes=size)
    add("drift", "layer", "name", project=project, **out)
    add("events", n={"type": int, "default": 100}, day={})
    add("ingest", "name", "source", project=project)
    add(
        "register",
        "layer",
        "name",
        project=project,
        day={},
        no_drop={"action": "store_true"},
        partition_by={"action": "append"},
    )
    for name in ("sync", "drop", "count", "describe"):
        add(name, "layer", "name", project=project)
    add("sample", "layer", "name", project=project, n={"type": int})
    add("tables", "layer")
    add("sql", "text", **out)
    for name in ("models", "build-all"):
        add(name, project=project)
    add("build", "name", project=project)
    add("ingest-text", "name", "source", project=project, multi_line={"action": "store_true"})
    column = {"action": "append", "required": True, "help": "source:type:name"}
    add("silver", "name", project=project, column=column)
    add("stream-silver", "name", project=project, column=column, files_per_batch={"type": int, "default": 1000})
    add("gold", "name", "select", project=project)
    add("stream-topic", "topic", "name", project=project)
    add("files", "prefix", **out)
    add("topics", **out)
    add("produce", "topic", n=ten, prefix={"default": "event_"})
    add("consume", "topic", n=ten)
    return parser


def _give(result: DataFrame, a: argparse.Namespace) -> None:
    """All rows: to ``--out`` from the executors, else printed one partition at a time."""
    if getattr(a, "out", None):
        result.write.mode("error").format(a.format).save(a.out)
        return
    for row in chain([result.columns], result.toLocalIterator()):
        print(f"|{'|'.join('NULL' if v is None else str(v) for v in row)}|")


def main(arguments: Sequence[str] | None = None) -> int:
    a = _parser().parse_args(arguments)
    conf = None
    if a.endpoint:
        keys = (os.environ["AWS_ACCESS_KEY_ID"], os.environ["AWS_SECRET_ACCESS_KEY"])
        conf = object_store_conf(a.endpoint, *keys, ssl=a.endpoint.startswith("https:"))
    spark = build_session(f"strata-{a.command}", conf)
    try:
        result = _COMMANDS[a.command](spark, Lake(a.root), a)
    except StrataError as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return getattr(error, "exit_code", 1)
    if isinstance(result, DataFrame):
        _give(result, a)
    elif isinstance(result, dict):
        print(*[f"{name}: {value}" for name, value in result.items()], sep="\n")
    elif isinstance(result, list):
        print(*result, sep="\n")
    elif result is not None:
        print(result)
    return 0


if __name__ == "__main__":
    sys.exit(main())
