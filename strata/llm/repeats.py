"""Long repeated byte strings, marked through run-length compressed suffix indexes.

Every window of ``LENGTH`` bytes names its anchor: the leftmost of its ``GRAM``-byte strings whose
hash is least. Equal windows name equal anchors, so windows are dealt by anchor, and windows of
different anchors need no comparison. All windows of a document with the same anchor place form one
context (a stretch of text); every window lies in exactly one.

1. Contexts whose anchor occurs once in the corpus are out. Those whose whole text occurs twice are
   marked as a whole, wherever they stand.
2. Anchors with several different contexts go to an index: the contexts' suffixes are sorted, the
   Burrows-Wheeler transform is compressed to runs, and text positions are sampled at run ends.
   Common prefixes are measured at the samples only; within a run the length follows from the
   preceding text position, so matching statistics stream along the text. Matches of ``LENGTH`` or
   more are marked.
3. Anchors whose different contexts exceed ``CROWD_BYTES`` are compared window by window instead,
   by hash, dealt over all tasks: no group has to fit in one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import partitions, settle

LENGTH = 200
GRAM = 48
INDEX_BYTES, CROWD_BYTES = 1 << 19, 1 << 20
_PART = 1 << 20
_PLACE = np.uint64(_PART * 2 - 1)
_LAST = 2**63 - 1
_BYTE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    power, inverse = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 2**64), np.uint64)
    power[0] = inverse[0] = 1
    return np.cumprod(power), np.cumprod(inverse)


_POWER, _INVERSE = _powers(_PART + 4 * LENGTH)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Part:
    """At most ``_PART`` window starts of one document, and the hashes of its byte ranges."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _POWER[:n], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        ends = starts + lengths
        return _mix((self._sums[ends] - self._sums[starts]) * _INVERSE[starts] + np.uint64(1))

    def contexts(self, length: int = LENGTH, gram: int = GRAM):
        """Anchor hash, text hash, first and last window start of every context."""
        grams = self.hashes(np.arange(len(self._sums) - gram), gram)
        # A gram's hash above its place: the least is the leftmost of those with the least hash.
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        width, have = length - gram + 1, 1
        while 2 * have <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
        anchor = (least & _PLACE).astype(np.int64)
        firsts = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        lasts = np.concatenate([firsts[1:], [len(anchor)]]) - 1
        text = self.hashes(firsts, lasts - firsts + length)
        text ^= (lasts - firsts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return grams[anchor[firsts]].view(np.int64), text.view(np.int64), firsts, lasts


def _parts(data: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, Part]]:
    for at in range(0, max(0, len(data) - length + 1), _PART):
        yield at, Part(data[at : at + _PART + length - 1])


# --- the index ------------------------------------------------------------------------------------


def suffix_order(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; each ends at its context's end, equal ones by place."""
    n = len(data)
    place = np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(7):
        at = np.minimum(place + k, n - 1)
        key = key * 257 + np.where(place + k < ends, data[at].astype(np.int64) + 1, 0)
    order = np.argsort(key, kind="stable")
    key = key[order]
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.concatenate([starts, [n]]))
    rank[order] = np.repeat(starts, sizes)
    open_ = np.flatnonzero(np.repeat(sizes > 1, sizes))
    step, longest = 7, int((ends - place).max(initial=0))
    while len(open_):
        at = order[open_]
        done = step >= longest
        second = at if done else np.where(
            at + step < ends[at], rank[np.minimum(at + step, n - 1)] + 1, 0
        )
        key = rank[at] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        key, at = key[by], at[by]
        order[open_] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.concatenate([starts, [len(at)]]))
        rank[at] = np.repeat(open_[starts], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


def common_prefix(data: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(
        padded.view(np.uint8)[:8].view("<u8"), shape=(len(data) + 1,), strides=(1,)
    )
    most = np.minimum(ends[a] - a, ends[b] - b)
    found = most.copy()
    left, at = np.arange(len(a)), 0
    while len(left):
        left = left[at < most[left]]
        x = words[a[left] + at] ^ words[b[left] + at]
        differ = x != 0
        low = x[differ] & (~x[differ] + np.uint64(1))
        found[left[differ]] = np.minimum(
            most[left[differ]], at + np.log2(low.astype(np.float64)).astype(np.int64) // 8
        )
        left, at = left[~differ], at + 8
    return found


class RunIndex:
    """Run-length compressed transform of several contexts, sampled at the ends of its runs."""

    def __init__(self, contexts: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(contexts), np.uint8)
        sizes = np.array([len(c) for c in contexts], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.ends = np.repeat(self.bounds[1:], sizes)
        order = suffix_order(self.data, self.ends)
        before = self.data[np.maximum(order - 1, 0)].astype(np.int64)
        first = np.zeros(len(self.data), bool)
        first[self.bounds[:-1][sizes > 0]] = True
        before = np.where(first[order], -1 - order, before)  # nothing precedes: a symbol of its own
        heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.symbols = before[heads]
        self.runs = np.diff(np.concatenate([heads, [len(order)]]))
        #: Text positions at the head of each run, and at the end of the run before it.
        self.sample = order[heads]
        self.sample_before = order[heads - 1]
        self._next = np.full(len(order), -1, np.int64)
        self._next[order[:-1]] = order[1:]

    def matching_statistics(self) -> np.ndarray:
        """For each text position the longest match that also begins elsewhere in the contexts.

        With its lower neighbour a position shares what is measured at the last sample at or before
        it, less the distance; with its upper neighbour, what that one shares with it.
        """
        n = len(self.data)
        measured = np.zeros(n, np.int64)
        if n:
            measured[self.sample[1:]] = common_prefix(
                self.data, self.ends, self.sample[1:], self.sample_before[1:]
            )
        sampled = np.zeros(n, bool)
        sampled[self.sample] = True
        place = np.arange(n)
        last = np.maximum.accumulate(np.where(sampled, place, 0))
        lower = measured[last] - (place - last)
        upper = np.where(self._next >= 0, lower[self._next], 0)
        return np.maximum(lower, upper)

    def marked(self, length: int = LENGTH) -> list[list[tuple[int, int]]]:
        """Per context the stretches covered by strings of ``length`` that begin elsewhere too."""
        hit = self.matching_statistics() >= length
        out: list[list[tuple[int, int]]] = [[] for _ in self.bounds[1:]]
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        context = np.searchsorted(self.bounds, a, side="right") - 1
        # A run of hits never crosses contexts: the last bytes of one are too short to match.
        for c, x, y in zip(context.tolist(), a.tolist(), b.tolist(), strict=True):
            start = int(self.bounds[c])
            out[c].append((x - start, y - 1 - start + length))
        return out


# --- the job --------------------------------------------------------------------------------------

_CONTEXT = "anchor bigint, body bigint, k1 bigint, k2 bigint, first int, last int"


def _text_key(text: Column, unknown: Column) -> Column:
    """Tells texts of one id apart, and texts without an id from those of the largest one."""
    return F.when(unknown, F.xxhash64(text, F.lit(1))).otherwise(F.xxhash64(text))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("k1"),
        _text_key(text, F.col(id_col).isNull()).alias("k2"),
        text.cast("binary").alias("data"),
    )


def _bytes(value: bytes | None) -> np.ndarray:
    return np.frombuffer(value or b"", np.uint8)


def contexts(docs: DataFrame) -> DataFrame:
    """All contexts of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for k1, k2, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at, part in _parts(_bytes(data)):
                    anchor, body, first, last = part.contexts()
                    n = len(anchor)
                    whole = (anchor, body, np.full(n, k1), np.full(n, k2), first + at, last + at)
                    for column, values in zip(columns, whole, strict=True):
                        column.append(values)
            if columns[0]:
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=["anchor", "body", "k1", "k2", "first", "last"],
                )

    return docs.mapInArrow(run, _CONTEXT)


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of wanted contexts (``anchor``, ``n``, ``crowded``, ``k1``, ``k2``, ``first``,
    ``last``)."""

    per = wanted.groupBy("k1", "k2").agg(
        F.collect_list(F.struct("anchor", "n", "crowded", "first", "last")).alias("cuts")
    )
    rows = docs.join(per, ["k1", "k2"])
    return rows.select("k1", "k2", "data", F.explode("cuts").alias("c")).select(
        "k1",
        "k2",
        "c.anchor",
        "c.n",
        "c.crowded",
        "c.first",
        F.substring(
            "data", F.col("c.first") + 1, F.col("c.last") - F.col("c.first") + LENGTH
        ).alias("data"),
    )


_MARK = "k1 bigint, k2 bigint, start int, stop int"


def _indexed(cut: DataFrame) -> DataFrame:
    """Marks of contexts, anchors dealt over tasks and indexed a few at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= INDEX_BYTES and row[0] != held[-1][0]:
                    yield found(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield found(held)

    def found(rows: list[tuple]) -> pa.RecordBatch:
        index = RunIndex([r[5] for r in rows])
        marks = [
            (k1, k2, first + a, first + b)
            for (_, n, k1, k2, first, _), own in zip(rows, index.marked(), strict=True)
            if n == 1
            for a, b in own
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = list(zip(*marks, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["k1", "k2", "start", "stop"],
        )

    rows = cut.select("anchor", "n", "k1", "k2", "first", "data")
    rows = rows.repartition(partitions(cut.sparkSession), "anchor").sortWithinPartitions("anchor")
    return rows.mapInArrow(run, _MARK)


def _windowed(cut: DataFrame) -> DataFrame:
    """Marks of contexts of crowded anchors, window by window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(6)]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                anchor, n, k1, k2, first, data = row
                at = np.arange(len(data) - LENGTH + 1)
                window = Part(_bytes(data)).hashes(at, LENGTH).view(np.int64)
                whole = (anchor, window, n, k1, k2, at + first)
                for column, value in zip(columns, whole, strict=True):
                    column.append(np.broadcast_to(value, len(at)))
            kinds = [pa.int64()] * 5 + [pa.int32()]
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=["anchor", "window", "n", "k1", "k2", "start"],
                )

    rows = cut.select("anchor", "n", "k1", "k2", "first", "data").mapInArrow(
        run, "anchor bigint, window bigint, n bigint, k1 bigint, k2 bigint, start int"
    )
    often = rows.groupBy("anchor", "window").agg(F.sum("n").alias("times")).where("times > 1")
    hits = rows.where("n = 1").join(often, ["anchor", "window"], "left_semi")
    return hits.select("k1", "k2", "start", (F.col("start") + LENGTH).alias("stop"))


def marks(docs: DataFrame) -> DataFrame:
    """Byte ranges (``k1``, ``k2``, ``start``, ``stop``) covered by a string that begins twice."""
    every = settle(contexts(docs), "contexts")
    often = every.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1")
    often = settle(often.select("anchor"), "anchors")  # plain on both sides, so that AQE may split
    shared = settle(every.join(often, "anchor", "left_semi"), "shared")
    bodies = shared.groupBy("anchor", "body").agg(
        F.count("*").alias("n"), F.min(F.struct("k1", "k2", "first", "last")).alias("one")
    )
    bodies = settle(bodies.select("anchor", "body", "n", "one.*"), "bodies")
    copies = bodies.where("n > 1").select("anchor", "body")
    whole = shared.join(copies, ["anchor", "body"], "left_semi").select(
        "k1", "k2", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop")
    )
    several = bodies.groupBy("anchor").agg(
        F.count("*").alias("m"),
        F.sum(F.col("last") - F.col("first") + F.lit(LENGTH)).alias("bytes"),
    )
    several = several.where("m > 1").select(
        "anchor", (F.col("bytes") > CROWD_BYTES).alias("crowded")
    )
    mixed = bodies.join(several, "anchor")
    cut = _cut(docs, mixed)
    return whole.unionByName(_indexed(cut.where("NOT crowded"))).unionByName(
        _windowed(cut.where("crowded"))
    )


def _rest(data: np.ndarray, ranges: list[dict] | None) -> tuple[int, int, np.ndarray]:
    """Bytes removed, maximal removed runs, and the remaining bytes."""
    if not ranges:
        return 0, 0, data
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, [r["start"] for r in ranges], 1)
    np.add.at(edges, [r["stop"] for r in ranges], -1)
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return int(gone.sum()), spans, data[~gone]


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary).

    Each byte covered by a ``LENGTH``-byte string that also begins anywhere else, in the same
    document or another, is removed; strings are judged on the input. NULL texts are empty, texts
    shorter than ``LENGTH`` stay whole. NULL ids are ids like any other; rows equal in id and text
    are copies of each other. An empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k1, raw, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = _bytes(raw)
                removed, spans, kept = _rest(data, ranges)
                rows.append((k1, len(data), removed, spans, kept.tobytes()))
            kinds = [pa.int64()] * 4 + [pa.binary()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    docs = _keyed(df, id_col, text_col)
    per = marks(docs).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges")
    )
    rows = docs.join(per, ["k1", "k2"], "left")
    unknown = (F.col("k1") == _LAST) & (F.col("k2") == F.xxhash64("data", F.lit(1)))
    rows = rows.select(F.when(~unknown, F.col("k1")).alias("doc_id"), "data", "ranges")
    return rows.mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
