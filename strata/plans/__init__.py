from strata.plans.datasets import build_gold, build_silver, ingest_text, parse_mapping
from strata.plans.events import EVENTS, EVENTS_GOLD, run_events
from strata.plans.flights import FLIGHTS, FLIGHTS_GOLD, run_flights
from strata.plans.incremental import (
    ingest_new,
    ingested_files,
    merged_gold,
    pending_files,
    read_states,
    update_states,
)
from strata.plans.models import build_all, build_model, list_models

__all__ = [
    "EVENTS",
    "EVENTS_GOLD",
    "FLIGHTS",
    "FLIGHTS_GOLD",
    "build_all",
    "build_gold",
    "build_model",
    "build_silver",
    "ingest_new",
    "ingested_files",
    "merged_gold",
    "pending_files",
    "read_states",
    "update_states",
    "ingest_text",
    "list_models",
    "parse_mapping",
    "run_events",
    "run_flights",
]
