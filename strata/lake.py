"""Names and places: a dataset is (layer, project, name); a lake gives it a path and a table."""

from __future__ import annotations

import re
from dataclasses import dataclass

from strata.errors import InvalidName

LAYERS = ("bronze", "silver", "gold")

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_TOPIC = re.compile(r"[A-Za-z0-9._-]{1,249}")


def check_identifier(text: str) -> str:
    if not _IDENTIFIER.fullmatch(text):
        raise InvalidName(f"not a plain identifier: {text!r}")
    return text


def check_topic(text: str) -> str:
    if not _TOPIC.fullmatch(text) or text in {".", ".."}:
        raise InvalidName(f"not a topic name: {text!r}")
    return text


@dataclass(frozen=True)
class DatasetRef:
    layer: str
    project: str
    name: str

    def __post_init__(self) -> None:
        if self.layer not in LAYERS:
            raise InvalidName(f"layer must be one of {LAYERS}: {self.layer!r}")
        check_identifier(self.project)
        check_identifier(self.name)

    def at(self, layer: str) -> DatasetRef:
        """The same dataset in another layer."""
        return DatasetRef(layer, self.project, self.name)


@dataclass(frozen=True)
class Lake:
    """A root folder (any Hadoop file system) plus a prefix for its schemas in the catalog."""

    root: str
    schema_prefix: str = ""

    def __post_init__(self) -> None:
        if self.schema_prefix:
            check_identifier(self.schema_prefix)

    def schema(self, layer: str) -> str:
        return f"{self.schema_prefix}{layer}"

    def layer_path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def path(self, ref: DatasetRef) -> str:
        return f"{self.layer_path(ref.layer)}/{ref.project}/{ref.name}"

    def table(self, ref: DatasetRef) -> str:
        return f"{self.schema(ref.layer)}.{ref.project}_{ref.name}"

    @property
    def topics_path(self) -> str:
        return f"{self.root.rstrip('/')}/topics"

    def topic_path(self, topic: str) -> str:
        return f"{self.topics_path}/{check_topic(topic)}"

    def ends_path(self, topic: str) -> str:
        return f"{self.root.rstrip('/')}/_topic_ends/{check_topic(topic)}"

    def manifest_path(self, ref: DatasetRef) -> str:
        """Where the batches of a dataset that arrived whole are noted."""
        return f"{self.root.rstrip('/')}/_manifests/{ref.layer}/{ref.project}/{ref.name}"

    def states_path(self, ref: DatasetRef) -> str:
        """Partial aggregates from which a gold dataset is merged."""
        return f"{self.root.rstrip('/')}/_states/{ref.project}/{ref.name}"

    def quarantine_path(self, ref: DatasetRef) -> str:
        return f"{self.root.rstrip('/')}/_quarantine/{ref.project}/{ref.name}"

    def ledger_path(self, flow: str, step: str) -> str:
        root = self.root.rstrip("/")
        return f"{root}/_ledger/{check_identifier(flow)}/{check_identifier(step)}"

    def checkpoint_path(self, query: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{check_identifier(query)}"
