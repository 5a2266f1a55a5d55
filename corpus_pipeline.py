"""From raw documents to packed sequences: the stages of the training-data pipeline.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps, all but the last with
the columns of ``documents``. ``run`` writes every stage to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import lines, mixing, packing, quality, simhash
from strata.llm.common import settle, table
from strata.llm.queries import MIX_REST, MIX_WEIGHTS, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the cascade rejects."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier line; ``n_chars`` follows the text."""
    kept = lines.dedup_lines(docs)
    return with_chars(kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: fingerprints of 3-word shingles that differ in
    3 bits or fewer are linked, and of what is linked the smallest id stays (NULL ids last)."""
    return simhash.keep_one(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights, in random order."""
    return mixing.mix(docs, MIX_WEIGHTS, rest_weight=MIX_REST)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and place."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


def with_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    chars = F.length("text").cast(kind)
    return docs.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), chars))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing_weights),
    ("best-fit packing", best_fit_packing),
]

#: SimHash groups and best-fit places are not expressible in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "-".join(name.lower().split()))
    return STAGES[-1][1](spark, docs, sf_dir)
