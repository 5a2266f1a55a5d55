"""Best-fit packing of documents into sequences of a fixed number of tokens, in supersteps.

Documents and gaps (what is free at the end of a sequence) are tables. A superstep sorts both by size
into ranges and sweeps upwards: documents are stacked, and a gap takes the largest one below it that
no smaller gap took, so each gap meets its best fit and conflicts are settled by rank. What a range
cannot match among its own rows is matched across ranges by rank, from two counts a range. Gaps
shrink by what they took, and the next superstep follows, until no document is left.

Supersteps take documents in classes, largest first, as best fit by descending size does. A gap that
holds the best fitting size several times is offered as that many equal slots, so short documents
need few supersteps; their number grows with the logarithm of the corpus at most. The driver sees
counts by size (``capacity`` is their bound) and by range. Every table of a superstep is written, so
a lost executor costs a reread.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import settle
from strata.llm.encoding import encoder, give_back
from strata.workspace import scratch_folder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"

#: A class reaches from the largest size left down to this share of it. Sizes over half the capacity
#: (each needs its own sequence) are one class, and so are those up to the second share of it.
CLASS, SMALL = 0.5, 1 / 3
ROWS_PER_TASK = 500_000

_DOC, _SLOT, _PLACED = 0, 1, 2
_SWEPT = "kind int, size int, id bigint, sequence_id bigint, part int, rank bigint"


def pieces(
    df: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Token ids of every whole text and ``end_id``, cut where they exceed ``capacity``.

    Only longer documents are cut, into full pieces; the first may be shorter. NULL and empty texts
    are ``end_id`` alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            docs, texts, done = batch.column(0), batch.column(1), 0
            for flat, sizes in encode.stretches_with_end(texts, end_id):
                yield cut_up(docs.slice(done, len(sizes)), flat, sizes)
                done += len(sizes)
            del batch, docs, texts
            give_back()

    def cut_up(docs: pa.Array, flat: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        rows: list[tuple] = []
        every, at = memoryview(flat).cast("B"), 0
        for doc, n in zip(docs.to_pylist(), sizes.tolist(), strict=True):
            data = every[4 * at : 4 * (at + n)]
            at += n
            stop = (n - 1) % capacity + 1
            start = piece = 0
            while start < n:
                crc = zlib.crc32(data[4 * start : 4 * stop])
                rows.append((doc, piece, start, stop - start, crc))
                start, stop, piece = stop, stop + capacity, piece + 1
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def _matched(is_slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of documents and of the slots that take them, rows being sorted by size.

    A slot takes the document on top of the stack. With the height of the stack as level, documents
    and slots of one level alternate, so partners are neighbours there.
    """
    height = np.cumsum(1 - 2 * is_slot.astype(np.int64))
    order = np.argsort(height + is_slot, kind="stable")
    level = (height + is_slot)[order]
    slot = is_slot[order]
    pair = np.flatnonzero(~slot[:-1] & slot[1:] & (level[:-1] == level[1:]))
    return order[pair], order[pair + 1]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: documents placed, then documents and slots left with their rank in the range."""
    table = [[c.to_numpy() for c in b.columns] for b in batches if b.num_rows]
    if not table:
        return
    size, kind, ids = (np.concatenate(c) for c in zip(*table, strict=True))
    docs, slots = _matched(kind == _SLOT)
    sequence, rank = np.full(len(ids), -1, np.int64), np.zeros(len(ids), np.int64)
    sequence[docs] = ids[slots]
    kind = kind.copy()
    kind[docs] = _PLACED
    stays = np.ones(len(ids), bool)
    stays[slots] = False
    for left in (_DOC, _SLOT):
        own = (kind == left) & stays
        rank[own] = np.arange(own.sum())
    part = np.full(len(ids), TaskContext.get().partitionId(), np.int32)
    columns = [kind, size, ids, sequence, part, rank]
    names = ["kind", "size", "id", "sequence_id", "part", "rank"]
    yield pa.RecordBatch.from_arrays([pa.array(c[stays]) for c in columns], names=names)


def across(left: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Runs of partners in different ranges, from the documents and slots left in each range.

    A run is (documents' range, first rank, last rank, slots' range, first rank, number of the
    first pair); its documents are taken from the last rank downwards. There are fewer than two
    runs a range.
    """
    stack: list[tuple[int, int]] = []
    runs, pairs = [], 0
    for part in sorted(left):
        docs, slots = left[part]
        at = 0
        while at < slots and stack:
            below, count = stack.pop()
            taken = min(count, slots - at)
            runs.append((below, count - taken, count - 1, part, at, pairs))
            at, pairs = at + taken, pairs + taken
            if taken < count:
                stack.append((below, count - taken))
        if docs:
            stack.append((part, docs))
    return runs


def _crossed(swept: DataFrame, runs: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """Documents placed across ranges. Only the runs, two a range at most, are broadcast."""
    spark = swept.sparkSession
    docs = [(p, lo, hi, pair + hi, -1) for p, lo, hi, _, _, pair in runs]
    slots = [(p, at, at + hi - lo, pair - at, 1) for _, lo, hi, p, at, pair in runs]

    def numbered(kind: int, spans: list[tuple[int, int, int, int, int]]) -> DataFrame:
        table = spark.createDataFrame(spans, "p int, lo bigint, hi bigint, base bigint, way int")
        inside = F.expr("part = p AND rank BETWEEN lo AND hi")
        rows = swept.where(F.col("kind") == kind).join(F.broadcast(table), inside)
        return rows.withColumn("pair", F.expr("base + way * rank"))

    taken = numbered(_SLOT, slots).select("pair", F.col("id").alias("sequence_id"))
    rows = numbered(_DOC, docs).drop("sequence_id").join(taken, "pair")
    return rows.withColumn("kind", F.lit(_PLACED)).select(*swept.columns)


def _counts(df: DataFrame, *columns: str) -> Counter:
    """Rows by ``columns``; bounded by the number of sizes and ranges."""
    return Counter({tuple(r)[:-1]: r[-1] for r in df.groupBy(*columns).count().collect()})


def _slots_per_gap(sizes: list[int], capacity: int) -> list[int]:
    """For each size of a gap, how often the largest of ``sizes`` that fits goes into it."""
    fits = [bisect_right(sizes, gap) for gap in range(capacity + 1)]
    return [gap // sizes[k - 1] if k else 0 for gap, k in enumerate(fits)]


def _new_sequences(counts: Counter, sizes: list[int], capacity: int) -> int:
    """At least so many sequences hold all documents of a class."""
    tokens = sum(s * counts[s] for s in sizes)
    return max(-(-tokens // capacity), sum(counts[s] for s in sizes if 2 * s > capacity))


def _class(largest: int, capacity: int) -> int:
    """The smallest size that is in one class with ``largest``, the largest size left."""
    if 2 * largest > capacity:
        return capacity // 2 + 1
    return max(1, int(CLASS * largest)) if largest > SMALL * capacity else 1


def _gaps(spark: SparkSession, first: int, count: int, capacity: int, tasks: int = 1) -> DataFrame:
    new = spark.range(first, first + count, numPartitions=tasks)
    return new.select(F.col("id").alias("sequence_id"), F.lit(capacity).alias("free"))


def pack(
    parts: DataFrame, capacity: int = 1024, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``parts`` (as from ``pieces``) with ``sequence_id`` and gapless ``offset``.

    Equal rows are packed each for itself. An empty table stays empty. ``rows_per_task`` is about
    how many documents and slots a range of a superstep has.
    """
    spark = parts.sparkSession
    parts = settle(parts.withColumn("id", F.monotonically_increasing_id()), "pieces")
    size = F.col("length").cast("int").alias("size")
    docs = settle(
        parts.select(size, "id").repartitionByRange("size", "id").sortWithinPartitions("size"),
        "sizes",
    )
    folder = scratch_folder(spark, "supersteps")
    written: list[str] = []

    def write(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    counts = Counter({s: n for (s,), n in _counts(docs, "size").items()})
    opened, step, reached = 0, 0, capacity + 1
    left = docs.limit(0)  # documents of the class that found no gap yet
    gaps = _gaps(spark, 0, 0, capacity)
    free: Counter = Counter()
    while counts:
        low = _class(max(counts), capacity)
        sizes = sorted(s for s in counts if s >= low)
        if not any(gap >= sizes[0] for gap in free):
            new = _new_sequences(counts, sizes, capacity)
            tasks = -(-new // rows_per_task)
            gaps = gaps.unionByName(_gaps(spark, opened, new, capacity, tasks))
            free[capacity] += new
            opened += new
        times = _slots_per_gap(sizes, capacity)
        rows = sum(counts[s] for s in sizes) + sum(n * times[gap] for gap, n in free.items())

        own = left.unionByName(docs.where(F.col("size").between(low, reached - 1)))
        number = F.get(F.expr(f"array({', '.join(map(str, times))})"), F.col("free"))
        slots = gaps.withColumn("n", number).where("n > 0")
        slots = slots.withColumn("slot", F.explode(F.sequence(F.lit(1), "n")))
        slots = slots.select(
            F.expr("free div n").cast("int").alias("size"),
            F.lit(_SLOT).alias("kind"),
            F.col("sequence_id").alias("id"),
        )
        both = own.select("size", F.lit(_DOC).alias("kind"), "id").unionByName(slots)
        order = ["size", "kind", "id"]
        ranges = both.repartitionByRange(-(-rows // rows_per_task), *order)
        swept = ranges.sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT)
        swept = write(swept, f"swept-{step}")
        written.append(f"{folder}/swept-{step}")

        found = _counts(swept, "kind", "part", "size")
        rest: dict[int, list[int]] = {}
        for (kind, part, _), n in found.items():
            if kind != _PLACED:
                rest.setdefault(part, [0, 0])[kind] += n
        runs = across({part: (d, s) for part, (d, s) in rest.items()})
        placed = swept.where(F.col("kind") == _PLACED)
        left = swept.where(F.col("kind") == _DOC).select("size", "id")
        gone = Counter()
        for (kind, _, s), n in found.items():
            gone[s] += n if kind == _PLACED else 0
        if runs:
            crossed = write(_crossed(swept, runs), f"crossed-{step}")
            written.append(f"{folder}/crossed-{step}")
            placed = placed.unionByName(crossed)
            left = left.join(crossed.select("id"), "id", "left_anti").select("size", "id")
            gone += Counter({s: n for (s,), n in _counts(crossed, "size").items()})
        counts -= gone
        reached = low

        if counts:
            taken = placed.select("sequence_id", (-F.col("size")).alias("free"))
            gaps = gaps.unionByName(taken).groupBy("sequence_id")
            gaps = gaps.agg(F.sum("free").cast("int").alias("free"))
            gaps = write(gaps.where(F.col("free") >= min(counts)), f"gaps-{step}")
            free = Counter({g: n for (g,), n in _counts(gaps, "free").items()})
        step += 1

    placed = spark.createDataFrame([], _SWEPT)
    if written:
        placed = spark.read.schema(_SWEPT).parquet(*written).where(F.col("kind") == _PLACED)
    rows = parts.join(placed.select("id", "sequence_id"), "id")
    # A sequence has at most ``capacity`` documents.
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "id")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    offset = F.coalesce(before, F.lit(0)).alias("offset")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"]
    return rows.select(*columns, offset)
