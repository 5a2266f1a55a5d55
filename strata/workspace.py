"""Scratch folders for results that must be written before they can be read again."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from strata.errors import NoSharedFolder
from strata.lake import Lake

_FALLBACK = "/tmp/strata-scratch"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names, else one on the session's default file system."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or _FALLBACK).rstrip("/")


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh, empty folder as a full URI; it goes away when the session's JVM ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(
        f"{scratch_root(spark)}/strata-{label}-{uuid.uuid4().hex[:12]}"
    )
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    place = fs.makeQualified(path).toString()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and place.startswith("file:") and not _one_machine(spark.sparkContext.master):
        raise NoSharedFolder(
            "executors do not share the driver's disk: set spark.checkpoint.dir to a shared folder"
        )
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return place


def _one_machine(master: str) -> bool:
    return master.startswith("local") and not master.startswith("local-cluster")


def scratch_lake(spark: SparkSession, label: str) -> Lake:
    """A fresh, empty lake with its own schemas."""
    root = scratch_folder(spark, label)
    return Lake(root, re.sub(r"\W", "_", f"{label}_{root[-12:]}_"))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Was the folder's last write finished? Spark leaves ``_SUCCESS`` behind as its last step."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; a missing one is fine."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path``; none if it is missing."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]


def partition_folder(spark: SparkSession, path: str, key: str, value: str) -> str:
    """The folder that Spark gives a partition, odd characters escaped as Spark does."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path.rstrip('/')}/{escape.escapePathName(key)}={escape.escapePathName(value)}"
