"""Benchmark decontamination: an FM-index per shard of the corpus, searched for test phrases.

``index_shards`` cuts the corpus into runs of texts of about ``SHARD`` words and writes one FM-index
a run; it knows nothing of any benchmark, so one index serves many. The phrases are the windows of the test
items, searched in blocks of bounded size against every index: backward search through the ranks of
the wavelet matrix, places from sampled suffix positions, and the words of all occurrences merged into spans.
Texts longer than a shard stand in several, overlapping by a window less one word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import fmindex
from strata.llm.common import fresh, numbered, settle

SHARD, STRETCH = 1 << 19, 1 << 22
WINDOW = 10

#: Phrases that go to every task at once, at most some 60 MB; more are searched block by block.
BLOCK = 500_000

#: ASCII letters in lower case, digits and all bytes of other characters as they are, else a space.
_PLAIN = bytes(
    ord(chr(b).lower()) if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(128)
) + bytes(range(128, 256))


def text_words(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, a stretch of it at a time; NULL has none."""
    plain, at = (text or b"").translate(_PLAIN), 0
    while at < len(plain):
        stop = plain.find(b" ", at + STRETCH)
        stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


class _Numbers(dict):
    """Numbers from 1 in the order of asking."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + 1
        return number


class _Shard:
    """Pieces of texts that will share an index."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.symbols: list[np.ndarray] = []
        self.pieces: list[tuple[int, object, int, int, int]] = []  # doc, id, at, words, new words
        self.n = 0

    def add(self, doc: int, identity: object, at: int, words: list[bytes], new: int) -> None:
        self.pieces.append((doc, identity, at, len(words), new))
        if words:
            codes = map(self.numbers.__getitem__, words)
            self.symbols.append(np.fromiter(codes, np.int32, len(words)))
            self.symbols.append(np.zeros(1, np.int32))
            self.n += len(words) + 1

    def index(self) -> dict:
        if not self.n:
            return dict.fromkeys(("vocabulary", "planes", "counts", "sampled", "positions"), b"") | {
                "n": 0
            }
        return fmindex.build(np.concatenate(self.symbols), list(self.numbers)).to_row()


_FOUND = "doc bigint, spans array<struct<begin:bigint,end:bigint>>, numbers array<bigint>"
_BLOBS = ("vocabulary", "planes", "counts", "sampled", "positions")


def index_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    overlap: int = WINDOW - 1,
    shard_words: int = SHARD,
) -> DataFrame:
    """One row per shard: its pieces of texts (``doc``, ``id``, ``at``, ``size``, ``new``) and its index.

    ``doc`` numbers the rows of ``docs``, so rows with equal or NULL ids stay apart. ``at`` is the
    piece's first word in its text; ``new`` leaves out the words that the piece before has too.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = (TaskContext.get().partitionId() << 33) - 1
        shard = _Shard()

        def close() -> pa.RecordBatch:
            pieces = pa.array(
                [dict(zip(names, p, strict=True)) for p in shard.pieces], arrow_pieces
            )
            index = shard.index()
            arrays = [pa.array([index["n"]], pa.int64())]
            arrays += [pa.array([index[c]], pa.binary()) for c in _BLOBS]
            listed = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
            return pa.RecordBatch.from_arrays([listed, *arrays], names=schema.names)

        names = ("doc", "id", "at", "size", "new")
        for batch in batches:
            arrow_pieces = pa.struct(
                [
                    ("doc", pa.int64()),
                    ("id", batch.schema.field(0).type),
                    *[(c, pa.int64()) for c in ("at", "size", "new")],
                ]
            )
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                doc += 1
                identity, at, tail, first = key.as_py(), 0, [], True
                for words in text_words(text.as_py()):
                    while words:
                        room = max(shard_words - shard.n, 1)
                        some, words = words[:room], words[room:]
                        shard.add(doc, identity, at - len(tail), tail + some, len(some))
                        at, first = at + len(some), False
                        tail = (tail + some)[-overlap:] if overlap else []
                        if shard.n >= shard_words:
                            yield close()
                            shard = _Shard()
                if first:
                    shard.add(doc, identity, 0, [], 0)
                    if len(shard.pieces) >= shard_words:
                        yield close()
                        shard = _Shard()
        if shard.pieces:
            yield close()

    kind = docs.schema[id_col].dataType
    piece = T.StructType(
        [
            T.StructField("doc", T.LongType()),
            T.StructField("id", kind),
            *[T.StructField(c, T.LongType()) for c in ("at", "size", "new")],
        ]
    )
    schema = T.StructType(
        [
            T.StructField("pieces", T.ArrayType(piece)),
            T.StructField("n", T.LongType()),
            *[T.StructField(c, T.BinaryType()) for c in _BLOBS],
        ]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return settle(rows.mapInArrow(shards, schema), "shard-indexes")


def item_phrases(
    items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> tuple[DataFrame, DataFrame]:
    """The distinct windows (``phrase``, ``number`` from 0) and which items have them.

    A window is ``window`` words in a row; an item of fewer words, but not none, is one window.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []

            def packed() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(found, pa.binary())],
                    names=["item", "phrase"],
                )

            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                tail: list[bytes] = []
                length = 0
                for words in text_words(text.as_py()):
                    length += len(words)
                    run = tail + words
                    for k in range(len(run) - window + 1):
                        ids.append(key.as_py())
                        found.append(b" ".join(run[k : k + window]))
                    tail = run[len(run) - window + 1 :] if len(run) >= window else run
                    if len(found) >= 100_000:
                        yield packed()
                        ids, found = [], []
                if 0 < length < window:
                    ids.append(key.as_py())
                    found.append(b" ".join(tail))
            yield packed()

    key = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    rows = items.select(key, F.col(text_col).cast("binary").alias("text"))
    pairs = settle(rows.mapInArrow(windows, "item string, phrase binary").distinct(), "item-windows")
    phrases = numbered(pairs.select("phrase").distinct(), [F.col("phrase")], "number", "phrases")
    phrases = settle(phrases, "numbered-phrases")
    return phrases, pairs.join(phrases, "phrase").select("item", "number")


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges joined where they touch or overlap, in order."""
    if not len(begin):
        return begin, end
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > reach[:-1]])
    last = np.concatenate([new[1:], [True]])
    return begin[new], reach[last]


def _occurrences(
    index: fmindex.FMIndex, phrases: list[list[bytes]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every occurrence in the shard: which phrase, its position, its length."""
    numbers = {w: k for k, w in enumerate(index.vocabulary, 1)}
    by_length: dict[int, list[int]] = {}
    for k, words in enumerate(phrases):
        by_length.setdefault(len(words), []).append(k)
    which, where, length = [], [], []
    for size, members in by_length.items():
        codes = [[numbers.get(w, 0) for w in phrases[k]] for k in members]
        found, low, high = index.search(np.array(codes, np.int64))
        times = high - low
        rows = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
        which.append(np.repeat(np.array(members)[found], times))
        where.append(index.locate(rows))
        length.append(np.full(len(rows), size))
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in (which, where, length))


def search_shards(shards: DataFrame, phrases: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of ``doc``, ``spans`` (merged begin and end words) and ``numbers`` of phrases found.

    A document has a row per shard and block in which it has any. Blocks hold ``block`` phrases;
    only one is with a task at a time.
    """
    blocks = phrases.agg(F.max("number")).first()[0]
    blocks = 0 if blocks is None else blocks // block + 1

    def one(k: int) -> DataFrame:
        rows = phrases.where(f"number >= {k * block} AND number < {(k + 1) * block}")
        given = rows.orderBy("number").collect()  # at most ``block`` rows
        sent = shards.sparkSession.sparkContext.broadcast(
            (given[0].number, [bytes(r.phrase).split(b" ") for r in given])
        )

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, block_phrases = sent.value
            for batch in batches:
                for k in range(batch.num_rows):
                    row = {c: batch.column(c)[k].as_py() for c in ("n", *_BLOBS)}
                    pieces = pc.list_flatten(batch.column("pieces").slice(k, 1))
                    found = _in_pieces(row, pieces, block_phrases, first)
                    if found is not None:
                        yield found

        return shards.mapInArrow(search, _FOUND)

    found = [one(k) for k in range(blocks)] or [shards.sparkSession.createDataFrame([], _FOUND)]
    return settle(reduce(DataFrame.unionByName, found), "found-phrases")


def _in_pieces(
    row: dict, pieces: pa.StructArray, phrases: list[list[bytes]], first: int
) -> pa.RecordBatch | None:
    if not row["n"]:
        return None
    which, where, length = _occurrences(fmindex.FMIndex.from_row(row), phrases)
    if not len(where):
        return None
    doc, at, size = (np.asarray(pieces.field(c)) for c in ("doc", "at", "size"))
    held = np.flatnonzero(size)
    begins = np.cumsum(size[held] + 1) - (size[held] + 1)
    owner = np.searchsorted(begins, where, side="right") - 1
    order = np.lexsort((where, owner))
    which, where, length, owner = which[order], where[order], length[order], owner[order]
    # Positions grow with the owner and an occurrence ends within it, so one merge serves all.
    begin, end = merged(where, where + length)
    span_owner = np.searchsorted(begins, begin, side="right") - 1
    shift = at[held] - begins
    begin, end = begin + shift[span_owner], end + shift[span_owner]
    pairs = np.unique(np.stack([owner, which]), axis=1)
    hit = np.unique(owner)

    def offsets(owners: np.ndarray) -> pa.Array:
        return pa.array(np.append(np.searchsorted(owners, hit), len(owners)), pa.int32())

    spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], ["begin", "end"])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[held][hit]),
            pa.ListArray.from_arrays(offsets(span_owner), spans),
            pa.ListArray.from_arrays(offsets(pairs[0]), pa.array(pairs[1] + first)),
        ],
        names=["doc", "spans", "numbers"],
    )


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = []
        for row in batch.column(1):
            flat = row.values
            begin, end = merged(np.asarray(flat.field(0)), np.asarray(flat.field(1)))
            spans.append([{"begin": b, "end": e} for b, e in zip(begin.tolist(), end.tolist())])
        kind = batch.schema.field(1).type
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, kind)], names=batch.schema.names
        )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD,
    block: int = BLOCK,
) -> DataFrame:
    """Per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``, ``spans`` and ``items``.

    ``spans`` are the merged ranges of words inside any occurrence of a test window, ``items`` the
    ids (as text, sorted) of the test items that have such a window. NULL and empty texts have no
    words. Rows with equal or NULL ids are rows of their own; a NULL item id is an empty one, and
    repeated items count once. Other columns take no part. Empty tables give no rows, an empty
    benchmark no hits. Texts of any length are indexed whole.
    """
    shards = index_shards(docs, id_col, text_col, window - 1, shard_words)
    phrases, item_windows = item_phrases(items, item_col, item_text_col, window)
    found = search_shards(shards, phrases, block)

    pieces = shards.select(F.explode("pieces").alias("p")).select("p.doc", "p.id", "p.new")
    every = pieces.groupBy("doc").agg(F.first("id").alias("id"), F.sum("new").alias("n_words"))
    spans = found.groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.mapInArrow(_merge_spans, spans.schema)
    held = found.select("doc", F.explode("numbers").alias("number")).distinct()
    held = held.join(item_windows, "number").select("doc", "item").distinct()
    listed = held.groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))

    rows = every.join(spans, "doc", "left").join(listed, "doc", "left")
    lengths = F.transform("spans", lambda s: s["end"] - s["begin"])
    n_hit = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, n: a + n)
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce(n_hit, F.lit(0)).alias("n_hit"),
        F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"),
        F.coalesce("items", none).alias("items"),
    )


def _cut(text: bytes, spans: list[dict]) -> bytes:
    """``text`` without the spans of words; what stands between the words of a span goes too."""
    plain = text.translate(_PLAIN)
    data = np.frombuffer(plain, np.uint8) != 0x20
    padded = np.concatenate([[False], data, [False]])
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    out, last = [], 0
    for s in spans:
        out.append(text[last : starts[s["begin"]]])
        last = ends[s["end"] - 1]
    return b"".join([*out, text[last:]])


def decontaminate(
    docs: DataFrame, items: DataFrame, text_col: str = "text", **options
) -> DataFrame:
    """``docs`` with all occurrences of test windows cut out of ``text_col``.

    All rows and columns stay; texts without occurrences are as they were, NULL stays NULL.
    ``options`` are those of ``contamination``.
    """
    row, spans = fresh(docs, "_row", "_spans")
    rows = settle(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = contamination(rows, items, id_col=row, text_col=text_col, **options)
    found = found.where("n_hit > 0").select(row, F.col("spans").alias(spans))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, taken = batch.column(1), batch.column(2)
            new = [
                _cut(t.as_py(), s.as_py()).decode() if s.is_valid else None
                for t, s in zip(texts, taken, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(new, pa.string())], names=[row, text_col]
            )

    hit = rows.select(row, F.col(text_col).cast("binary")).join(found, row)
    schema = T.StructType(
        [T.StructField(row, T.LongType()), T.StructField(text_col, T.StringType())]
    )
    changed = hit.mapInArrow(cut, schema).withColumnRenamed(text_col, spans)
    text = F.coalesce(F.col(spans), F.col(text_col)).alias(text_col)
    out = [text if c.lower() == text_col.lower() else F.col(c) for c in docs.columns]
    return rows.join(changed, row, "left").select(*out)
