"""Importance resampling towards a target: hashed n-gram features, log ratios, Gumbel top-k.

A text's separators (every ASCII character that is no letter or digit) collapse to single spaces.
An overlapped regex scan with lookarounds at the word boundaries then emits the span of every run of
``n`` words, and the CRC of its bytes says into which bucket the run counts. Both corpora are counted
whole, combined inside the tasks; a bucket's gain is the logarithm of how much more frequent it is in
the target. A document's score is the sum of its gains plus Gumbel noise hashed from its id, so the
highest scores are a sample without replacement in proportion to the importance weights.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import fresh, numbered, settle

BUCKETS = 10_000

#: ASCII letters in lower case, digits and all bytes of other characters as they are, else a space.
_PLAIN = bytes(
    ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(128)
) + bytes(range(128, 256))


def collapsed(text: bytes | None) -> bytes:
    """The words of a text, A-Z lower-cased, with one space between; NULL has none."""
    return b" ".join((text or b"").translate(_PLAIN).split())


def feature_patterns(low: int, high: int) -> list[regex.Pattern]:
    """One pattern per length: a run of words that begins and ends at word boundaries."""
    return [
        regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (n - 1))
        for n in range(low, high + 1)
    ]


def feature_buckets(plain: bytes, patterns: Sequence[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every feature, repeats included."""
    found = [
        np.fromiter(
            (zlib.crc32(m.group()) for m in p.finditer(plain, overlapped=True)), np.uint32
        )
        for p in patterns
    ]
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(
    df: DataFrame, text_col: str, low: int, high: int, buckets: int
) -> DataFrame:
    """``bucket`` and ``n``, the features in it over all texts, for buckets that have any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, total = feature_patterns(low, high), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                hit = feature_buckets(collapsed(text.as_py()), patterns, buckets)
                total += np.bincount(hit, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"]
        )

    texts = df.select(F.col(text_col).cast("binary"))
    partial = texts.mapInArrow(count, "bucket int, n bigint")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Per bucket the smoothed log ratio of target over source in thousandths, rounded down."""
    s_all, t_all = float(sum(source.values())), float(sum(target.values()))

    def gain(b: int) -> int:
        above = (target.get(b, 0) + 1.0) * (s_all + buckets)
        below = (source.get(b, 0) + 1.0) * (t_all + buckets)
        return math.floor(1000 * math.log(above / below))

    return np.array([gain(b) for b in range(buckets)], np.int64)


def noise(identity: str, seed: int) -> int:
    """Gumbel noise in thousandths, the same for the same id wherever it is drawn."""
    h = int(hashlib.sha256(f"{seed}:{identity}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    keep: Sequence[str] | None = None,
    low: int = 1,
    high: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    min_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """Every row of ``docs`` with ``n_features``, ``weight``, ``score`` and ``rank``.

    ``keep`` names the columns that come along (``id_col`` only unless given); a column of ``docs``
    that has the name of a new one keeps it, and the new one gets underscores at its end. ``rank`` is 1, 2, 3 ... for
    the drawn rows: the ``percent`` highest scores, rounded down, of those with ``min_words`` words;
    ties go to the smaller id, then to the smaller key of what is kept, NULL ids last. NULL and
    empty texts have no features and weight 0. Rows with the same id share their noise; a NULL id is
    an empty one. An empty table stays empty; an empty target leaves only its smoothing. Texts of
    any length are scanned whole. What is counted is held as ``buckets`` numbers a task.
    """
    source_counts = bucket_counts(docs, text_col, low, high, buckets)
    target_counts = bucket_counts(target, target_text_col, low, high, buckets)
    # At most ``buckets`` rows each.
    gain = gains(
        {r.bucket: r.n for r in source_counts.collect()},
        {r.bucket: r.n for r in target_counts.collect()},
        buckets,
    )

    columns = list(keep or [id_col])
    kept = docs.select(*columns)
    words, features, weight, score, rank = fresh(
        kept, "n_words", "n_features", "weight", "score", "rank"
    )
    added = [words, features, weight, score]
    identity, text = fresh(kept, "_identity", "_plain_text")
    schema = T.StructType(
        [*kept.schema.fields, *[T.StructField(c, T.LongType()) for c in added]]
    )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = feature_patterns(low, high)
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                plain = collapsed(value.as_py())
                hit = feature_buckets(plain, patterns, buckets)
                total = int(gain[hit].sum())
                n_words = plain.count(b" ") + 1 if plain else 0
                rows.append((n_words, len(hit), total, total + noise(key.as_py(), seed)))
            new = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [
                pa.array([], pa.int64())
            ] * len(added)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *new], names=schema.names)

    named = F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias(identity)
    given = docs.select(named, F.col(text_col).cast("binary").alias(text), *columns)
    scored = settle(given.mapInArrow(weigh, schema), "importance")

    enough = scored.where(F.col(words) >= min_words)
    drawn = percent * enough.count() // 100
    rest = [F.xxhash64(*columns)]
    first = [F.col(id_col).asc_nulls_last()] if id_col in columns else []
    ordered = numbered(enough, [F.desc(score), *first, *rest], rank, "importance-ranks")
    place = F.when(F.col(rank) < drawn, F.col(rank) + 1).alias(rank)
    none = F.lit(None).cast("bigint").alias(rank)
    out = [*columns, features, weight, score]
    few = scored.where(F.col(words) < min_words).select(*out, none)
    return ordered.select(*out, place).unionByName(few)
