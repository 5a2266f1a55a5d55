"""Token-id files compressed by Re-Pair grammars, readable from any token on.

Documents are range-partitioned by id and encoded in that order; every ``SHARD`` tokens or so close
a shard, which is one row of a Parquet file: the documents' ids and lengths, and the token ids as a
grammar. Frequent id pairs are replaced by nonterminals round by round (many pairs that do not
overlap in one round) until no pair of neighbours occurs ``FREQUENT`` times. The rules and the number
of tokens each expands to are stored, and a ranged reader expands only the symbols that cover the
tokens asked for. A shard is built from its own tokens alone, so a lost executor costs its
unfinished shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import partitions
from strata.llm.encoding import encoder
from strata.workspace import scratch_folder

SHARD = 1 << 21
#: A rule takes 12 bytes and saves about two per occurrence.
FREQUENT = 16
#: How many pairs, most frequent first, one round replaces; the others wait for the next round.
RULES_PER_ROUND = 4096
_BUCKETS = 1 << 20

SHARD_SCHEMA = (
    "part int, shard int, n_tokens bigint, terminals int, doc_ids binary, doc_nulls binary, "
    "doc_tokens binary, rules binary, rule_lengths binary, n_symbols bigint, "
    "symbols_low binary, symbols_high binary"
)


def _frequent(pairs: np.ndarray, hashed: np.ndarray, least: int) -> np.ndarray:
    """The pairs that occur ``least`` times or more, the most frequent ``RULES_PER_ROUND``, sorted.

    A table of hashed counts rules out nearly all others before the exact count.
    """
    heavy = np.bincount(hashed, minlength=_BUCKETS) >= least
    found, counts = np.unique(pairs[heavy[hashed]], return_counts=True)
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] >= least][:RULES_PER_ROUND]
    return np.sort(found[order])


def compress(
    ids: np.ndarray, terminals: int, least: int = FREQUENT
) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (two columns; rule ``k`` is symbol ``terminals + k``) that expand to ids.

    In the symbols no two neighbours stand together ``least`` times. Every round replaces half of
    the occurrences of its pairs or more, so the rounds end.
    """
    symbols, rules = ids.astype(np.int64), [np.empty((0, 2), np.int64)]
    base = terminals
    while len(symbols) > 1:
        pairs = (symbols[:-1] << 32) | symbols[1:]
        hashed = (symbols[:-1] * 0x9E37 + symbols[1:]) & (_BUCKETS - 1)
        chosen = _frequent(pairs, hashed, least)
        if not len(chosen):
            break
        table = np.zeros(_BUCKETS, bool)
        table[((chosen >> 32) * 0x9E37 + (chosen & 0xFFFFFFFF)) & (_BUCKETS - 1)] = True
        places = np.flatnonzero(table[hashed])
        rule = np.minimum(np.searchsorted(chosen, pairs[places]), len(chosen) - 1)
        hit = chosen[rule] == pairs[places]
        places, rule = places[hit], rule[hit]
        # Of overlapping occurrences, every second one from the left is replaced.
        order = np.arange(len(places))
        starts = np.ones(len(places), bool)
        starts[1:] = np.diff(places) > 1
        take = (order - np.maximum.accumulate(np.where(starts, order, 0))) & 1 == 0
        places, rule = places[take], rule[take]
        symbols[places] = base + rule
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        symbols = symbols[keep]
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        base += len(chosen)
    return symbols, np.concatenate(rules)


def rule_lengths(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many tokens each rule expands to."""
    lengths = np.ones(terminals + len(rules), np.int64)
    for k, (left, right) in enumerate(rules.tolist(), terminals):
        lengths[k] = lengths[left] + lengths[right]
    return lengths[terminals:]


def _expanded(
    part: np.ndarray, rules: np.ndarray, terminals: int
) -> tuple[np.ndarray, np.ndarray]:
    """A table of the expansions that ``part`` needs, and where each symbol's begins in it."""
    needed = np.zeros(len(rules), bool)
    needed[part[part >= terminals] - terminals] = True
    pairs = rules.tolist()
    for k in range(len(rules) - 1, -1, -1):
        if needed[k]:
            for symbol in pairs[k]:
                if symbol >= terminals:
                    needed[symbol - terminals] = True
    texts: dict[int, np.ndarray] = {}

    def text(symbol: int) -> np.ndarray:
        return np.array([symbol], np.uint32) if symbol < terminals else texts[symbol]

    places, at = np.arange(terminals + len(rules)), terminals
    for k in np.flatnonzero(needed).tolist():
        left, right = pairs[k]
        texts[terminals + k] = np.concatenate([text(left), text(right)])
        places[terminals + k] = at
        at += len(texts[terminals + k])
    return np.concatenate([np.arange(terminals, dtype=np.uint32), *texts.values()]), places


def decode(
    symbols: np.ndarray,
    rules: np.ndarray,
    terminals: int,
    start: int = 0,
    count: int | None = None,
    lengths: np.ndarray | None = None,
) -> np.ndarray:
    """Tokens ``start`` to ``start + count``. With the stored ``lengths`` of the rules, only the
    symbols that cover the tokens asked for, and the rules under them, are expanded."""
    own = rule_lengths(rules, terminals) if lengths is None else lengths
    sizes = np.concatenate([np.ones(terminals, np.int64), own])[symbols]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    stop = total if count is None else min(total, start + count)
    if start >= stop:
        return np.empty(0, np.uint32)
    first, last = np.searchsorted(ends, [start, stop - 1], side="right")
    part, sizes = symbols[first : last + 1], sizes[first : last + 1]
    table, places = _expanded(part, rules, terminals)
    before = int(ends[first] - sizes[0])
    offsets = np.repeat(places[part] - (np.cumsum(sizes) - sizes), sizes)
    offsets += np.arange(len(offsets))
    return table[offsets][start - before : stop - before]


def pack(symbols: np.ndarray) -> tuple[bytes, bytes]:
    """Low 16 bits of each symbol, and its higher bits, one bit plane after the other."""
    high = symbols >> 16
    planes = int(high.max()).bit_length() if len(high) else 0
    return (
        symbols.astype("<u2").tobytes(),
        b"".join(np.packbits(((high >> k) & 1).astype(bool)).tobytes() for k in range(planes)),
    )


def unpack(low: bytes, high: bytes, n: int) -> np.ndarray:
    symbols = np.frombuffer(low, "<u2").astype(np.int64)
    size = (n + 7) // 8
    for k in range(len(high) // size if size else 0):
        plane = np.frombuffer(high, np.uint8, size, k * size)
        symbols |= np.unpackbits(plane, count=n).astype(np.int64) << (16 + k)
    return symbols


def write_ids(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_tokens: int = SHARD,
) -> None:
    """Writes the ids of every whole text, ``end_id`` after each, in ascending order of ``id_col``.

    NULL texts are empty, NULL ids come first, rows with equal ids stand in order of their texts.
    An empty table writes no shard. A document is never split between shards.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(tokenizer), TaskContext.get().partitionId()
        terminals, number = encode.vocabulary(), 0
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        sizes: list[int] = []
        held = 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate(tokens)
            symbols, rules = compress(flat, terminals)
            low, high = pack(symbols)
            row = {
                "part": part,
                "shard": number,
                "n_tokens": len(flat),
                "terminals": terminals,
                "doc_ids": np.array([i or 0 for i in ids], "<i8").tobytes(),
                "doc_nulls": np.packbits([i is None for i in ids]).tobytes(),
                "doc_tokens": np.array(sizes, "<u4").tobytes(),
                "rules": rules.astype("<u4").tobytes(),
                "rule_lengths": rule_lengths(rules, terminals).astype("<u4").tobytes(),
                "n_symbols": len(symbols),
                "symbols_low": low,
                "symbols_high": high,
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            flat, found = encode.encode_with_end(batch.column(1), end_id)
            ends, docs, last = np.cumsum(found), batch.column(0).to_pylist(), 0
            while last < len(docs):
                before = ends[last - 1] if last else 0
                stop = int(np.searchsorted(ends, before + shard_tokens - held)) + 1
                stop = min(stop, len(docs))
                tokens.append(flat[before : ends[stop - 1]])
                ids += docs[last:stop]
                sizes += found[last:stop].tolist()
                held += int(ends[stop - 1] - before)
                last = stop
                if held >= shard_tokens:
                    yield close()
                    ids, tokens, sizes, held, number = [], [], [], 0, number + 1
        if ids:
            yield close()

    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("shard", pa.int32()),
            ("n_tokens", pa.int64()),
            ("terminals", pa.int32()),
            *[(c, pa.binary()) for c in ("doc_ids", "doc_nulls", "doc_tokens", "rules", "rule_lengths")],
            ("n_symbols", pa.int64()),
            *[(c, pa.binary()) for c in ("symbols_low", "symbols_high")],
        ]
    )
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(partitions(df.sparkSession), "id")
    rows = rows.sortWithinPartitions("id", "text")
    rows.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "none").parquet(path)


def _tokens(row: dict, start: int = 0, count: int | None = None) -> np.ndarray:
    """Tokens of a shard's row."""
    symbols = unpack(row["symbols_low"], row["symbols_high"], row["n_symbols"])
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    lengths = np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)
    return decode(symbols, rules, row["terminals"], start, count, lengths)


def _shard_starts(files: DataFrame) -> DataFrame:
    """``part``, ``shard``, ``n_tokens`` and ``before``, the tokens of all shards before."""
    order = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = files.select("part", "shard", "n_tokens").withColumn(
        "before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))
    )
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_before")
    )
    return shards.join(parts, "part").select(
        "part", "shard", "n_tokens", (F.col("before") + F.col("part_before")).alias("before")
    )


def read_range(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """Tokens ``start`` to ``start + count`` of all, as rows of ``start`` and ``ids``, one per shard.

    Shards outside the range are not decoded, and of the others only the symbols that cover it.
    """
    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    end = F.col("before") + F.col("n_tokens")
    asked = _shard_starts(files).where((end > start) & (F.col("before") < start + count))
    rows = files.drop("n_tokens").join(asked, ["part", "shard"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = max(0, start - row["before"])
                ids = _tokens(row, at, start + count - row["before"] - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["before"] + at], pa.int64()),
                        pa.array([ids], pa.list_(pa.int64())),
                    ],
                    names=["start", "ids"],
                )

    return rows.mapInArrow(cut, "start bigint, ids array<bigint>")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it. Shards are summed within their part, parts
    (as many as the files had tasks) among each other.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                flat = _tokens(row).astype("<u4", copy=False)
                data = memoryview(flat).cast("B")
                sizes = np.frombuffer(row["doc_tokens"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                crcs = [
                    zlib.crc32(data[4 * (e - n) : 4 * e])
                    for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)
                ]
                null = np.unpackbits(
                    np.frombuffer(row["doc_nulls"], np.uint8), count=len(sizes)
                ).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(sizes), pa.int32()),
                        pa.array([row["shard"]] * len(sizes), pa.int32()),
                        pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null),
                        pa.array(ends - sizes),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(SHARD_SCHEMA).parquet(path)
    starts = _shard_starts(files).drop("n_tokens")
    docs = files.mapInArrow(
        documents,
        "part int, shard int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return docs.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def through_files(
    df: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None
) -> DataFrame:
    """Writes the ids (to a fresh shared folder unless ``path`` is given) and reads them back."""
    path = path or f"{scratch_folder(df.sparkSession, 'token-ids')}/ids"
    write_ids(df, path, tokenizer, end_id)
    return read_ids(df.sparkSession, path)
