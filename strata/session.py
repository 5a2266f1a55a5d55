"""The one place that configures a session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Let AQE size reducers by bytes instead of by core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(
    app: str, conf: Mapping[str, str] | None = None, master: str | None = None
) -> SparkSession:
    """Session for a job; ``conf`` (object store, catalog, ...) wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Session settings for an S3-compatible store read through ``s3a://`` paths."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }
