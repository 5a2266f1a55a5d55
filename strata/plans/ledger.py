"""Steps that a restart does not repeat.

A flow's ledger holds, per step, the digest of everything the step was made from and what came out.
A step whose note has the same digest, and whose output is whole, is skipped. The note goes before the
step starts and comes back when it is done, so a step that was lost on the way is run again. A step's
digest is part of the next one's, so changed inputs rebuild what follows and nothing else.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.lake import Lake
from strata.sinks import JobResult
from strata.sources import list_files
from strata.workspace import delete_folder, is_complete

_NOTE = "digest string, path string, row_count bigint, metrics string"


def listing_digest(spark: SparkSession, source: str) -> str:
    """Names, sizes and times of all files under ``source``; no content is read."""
    return frame_digest(list_files(spark, source))


def frame_digest(rows: DataFrame) -> str:
    """Of a frame's rows in any order: one row comes to the driver."""
    h = F.xxhash64(*rows.columns)
    found = rows.agg(
        F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)
    ).first()
    return hashlib.sha256(repr([str(v) for v in found]).encode()).hexdigest()


@dataclass
class Ledger:
    """Use one per run: it remembers the digest of the last step as an input of the next."""

    spark: SparkSession
    lake: Lake
    flow: str
    skipped: list[str] = field(default_factory=list)
    _before: str = ""

    def step(self, name: str, inputs: list[str], action: Callable[[], JobResult]) -> JobResult:
        """Run ``action``, or give back what it gave when its inputs were the same.

        ``inputs`` are texts: digests of listings, settings, the version of a rule.
        """
        parts = json.dumps([self.flow, name, self._before, *inputs])
        digest = self._before = hashlib.sha256(parts.encode()).hexdigest()
        place = self.lake.ledger_path(self.flow, name)
        if is_complete(self.spark, place):
            note = self.spark.read.schema(_NOTE).parquet(place).first()
            if note.digest == digest and is_complete(self.spark, note.path):
                self.skipped.append(name)
                return JobResult(note.path, note.row_count, json.loads(note.metrics))
        delete_folder(self.spark, place)
        result = action()
        row = [(digest, result.path, result.rows, json.dumps(result.metrics, default=str))]
        self.spark.createDataFrame(row, _NOTE).coalesce(1).write.parquet(place)
        return result
