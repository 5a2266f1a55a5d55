"""Layers of the events table that queries only read, written once a session.

A query that shows how files are found, counted, pruned or registered needs files to read, not a
copy of its own. The first such query writes them; they are written anew when the source's files
changed or the folder is gone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strata.lake import Lake
from strata.plans.events import EVENTS, build_events_silver, land_events
from strata.queries.base import LOADED_AT, sample_events
from strata.sources import list_files
from strata.workspace import is_complete, scratch_lake

_LAKES: dict[tuple, Lake] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Tells one state of the source's files from another, by their listing."""
    files = list_files(spark, f"{sf_dir}/events.parquet").agg(
        F.count("*"), F.sum("file_bytes"), F.max("modificationTime")
    )
    return (spark.sparkContext.applicationId, sf_dir, *files.first())


def landed_events(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with the events landed by day. For reading only."""
    state = _state(spark, sf_dir)
    lake = _LAKES.get(state)
    if lake is None or not is_complete(spark, lake.path(EVENTS)):
        lake = scratch_lake(spark, "events")
        land_events(sample_events(spark, sf_dir), lake)
        _LAKES[state] = lake
    return lake


def conformed_events(spark: SparkSession, sf_dir: str) -> Lake:
    """The same lake with silver too, and schemas that no other query uses."""
    landed = landed_events(spark, sf_dir)
    lake = Lake(landed.root, f"events_{uuid.uuid4().hex[:12]}_")
    if not is_complete(spark, lake.path(EVENTS.at("silver"))):
        build_events_silver(spark, lake, LOADED_AT)
    return lake
