"""Many small files to few large ones, a partition at a time.

The inventory of a dataset says which partitions have more files than their bytes need. Their rows
are written anew beside the dataset, in bins of about the target size, and compared with the old ones
by row digests. Only then each partition's folder is swapped by two renames. A reader that lists a
partition finds the old files or the new ones, never both; between the renames it finds none. What a
lost run left behind is put right by the next one (``recover``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from strata.errors import ReconciliationFailed
from strata.operators.digests import differing_buckets, row_digests, row_hash
from strata.sources import list_files, read_partitioned
from strata.workspace import child_folders, delete_folder

TARGET = 128 * 1024 * 1024

#: What Spark calls the folder of NULL.
_NONE = "__HIVE_DEFAULT_PARTITION__"


def _work(path: str) -> str:
    """Beside the dataset, on the same file system, so that a rename moves no bytes."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_compaction_{name}"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(old), jvm.org.apache.hadoop.fs.Path(new)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise ReconciliationFailed(f"could not move {old} to {new}")


def file_bins(spark: SparkSession, path: str, target_bytes: int = TARGET) -> DataFrame:
    """``folder``, ``file_path``, ``file_bytes`` and ``bin`` of every Parquet file under ``path``.

    Files of a folder are put into bins in order of size until a bin has ``target_bytes``; a folder
    is worth compacting if it has more files than bins. One row per file, no content read.
    """
    files = list_files(spark, path).where(F.col("file_path").endswith(".parquet"))
    files = files.withColumn("folder", F.regexp_extract("file_path", "^(.*)/[^/]*$", 1))
    order = Window.partitionBy("folder").orderBy(F.desc("file_bytes"), "file_path")
    before = F.sum("file_bytes").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = files.withColumn("bin", F.floor((before - 1) / F.lit(target_bytes)).cast("int"))
    return placed.select("folder", "file_path", "file_bytes", "bin")


def crowded_folders(spark: SparkSession, path: str, target_bytes: int = TARGET) -> DataFrame:
    """``folder``, ``files``, ``bins`` and ``total_bytes`` of the folders worth compacting."""
    counted = file_bins(spark, path, target_bytes).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"),
        F.greatest(F.count_distinct("bin"), F.lit(1)).alias("bins"),
        F.sum("file_bytes").alias("total_bytes"),
    )
    return counted.where("files > bins")


def recover(spark: SparkSession, path: str, key: str) -> list[str]:
    """Finish or undo the swaps of a lost run; names of the partitions that were put right."""
    work, mended = _work(path), []
    there = set(child_folders(spark, path))
    new = set(child_folders(spark, f"{work}/new"))
    for name in child_folders(spark, f"{work}/old"):
        if name.startswith(f"{key}=") and name not in there:
            _rename(spark, f"{work}/{'new' if name in new else 'old'}/{name}", f"{path}/{name}")
            mended.append(name)
    delete_folder(spark, work)
    return mended


def compact(
    spark: SparkSession, path: str, key: str, target_bytes: int = TARGET
) -> dict[str, tuple[int, int]]:
    """Files before and after of each partition of ``path`` (folders ``<key>=...``) that was compacted.

    Partitions with no more files than bins stay untouched. One writer at a time: if the files of a
    partition are no longer those that were read, nothing is swapped. Rows with map columns cannot
    be compared and are refused by Spark.
    """
    recover(spark, path, key)
    crowded = _crowded(spark, path, key, target_bytes)
    if not crowded:
        return {}
    work = _work(path)
    rows = read_partitioned(spark, path, {key: "string"})
    values = {name: _value(spark, name) for name in crowded}
    known = [v for v in values.values() if v is not None]
    null = F.col(key).isNull()
    asked = F.col(key).isin(known) if None not in values.values() else null | F.col(key).isin(known)
    old = rows.where(asked)

    # Rows of a partition go to its bins by their hash, so no task gets more than a bin's share.
    of = F.coalesce(F.col(key), F.lit(_NONE))
    pairs = [F.lit(x) for name, v in values.items() for x in (v or _NONE, crowded[name].bins)]
    columns = [c for c in rows.columns if c != key]
    dealt = old.withColumn("_bin", F.pmod(row_hash(columns), F.create_map(*pairs)[of]))
    dealt = dealt.repartition(sum(r.bins for r in crowded.values()), key, "_bin").drop("_bin")
    dealt.write.mode("overwrite").partitionBy(key).parquet(f"{work}/new")

    kept = spark.read.schema(rows.schema).parquet(f"{work}/new")
    digests = [row_digests(df, columns, [key], buckets=1) for df in (old, kept)]
    now = _crowded(spark, path, key, target_bytes)
    if now != crowded or not differing_buckets(*digests, [key]).isEmpty():
        delete_folder(spark, work)
        raise ReconciliationFailed(f"{path} changed while it was compacted; nothing was swapped")
    for name in crowded:
        _swap(spark, path, name)
    delete_folder(spark, work)
    after = file_bins(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()
    left = {_name(r.folder): r.n for r in after}
    return {name: (r.files, left[name]) for name, r in crowded.items()}


def _swap(spark: SparkSession, path: str, name: str) -> None:
    work = _work(path)
    _rename(spark, f"{path}/{name}", f"{work}/old/{name}")
    _rename(spark, f"{work}/new/{name}", f"{path}/{name}")


def _name(folder: str) -> str:
    return folder.rsplit("/", 1)[1]


def _crowded(spark: SparkSession, path: str, key: str, target_bytes: int) -> dict[str, Row]:
    """By folder name; a row per crowded partition comes to the driver."""
    found = {_name(r.folder): r for r in crowded_folders(spark, path, target_bytes).collect()}
    return {name: found[name] for name in sorted(found) if name.startswith(f"{key}=")}


def _value(spark: SparkSession, name: str) -> str | None:
    text = name.partition("=")[2]
    jvm = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog
    return None if text == _NONE else jvm.ExternalCatalogUtils.unescapePathName(text)
