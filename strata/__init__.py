"""Layered lakehouse work on Spark: land, conform, aggregate, register, reconcile, stream."""

from strata.lake import DatasetRef, Lake
from strata.session import build_session

__all__ = ["DatasetRef", "Lake", "build_session"]
