"""SimHash near-duplicates, found through tables of distances to reference fingerprints.

Two fingerprints within ``DISTANCE`` bits differ in their distance to any third one by no more than
that. So each fingerprint gets a table of its Hamming distances to many reference fingerprints
(pivots), pairs whose tables differ by more in any coordinate are discarded, and the survivors are
verified. Distances to pivots alone cannot deal 64-bit fingerprints to tasks (most random pairs are
about equally far from everything), so fingerprints first meet in cells: of five bit blocks at
least two are untouched by three flipped bits, which gives ten exact cell keys. Within a cell rows
are sorted by the first pivot distance, and only a band of it is compared.

A cell with many fingerprints is cut into chunks and every pair of chunks is one group, so that no
group grows with the corpus. Tasks give back spanning edges only, never all pairs. Components then
come from alternating large-star and small-star steps, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import fresh, partitions, settle

DISTANCE = 3
SEED = 42
_WIDTHS = (13, 13, 13, 13, 12)
_SMALL, _CHUNKS, _LARGE = 256, 64, 65_536

#: Reference fingerprints: fixed random numbers.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)


def _hashes(pieces: list[bytes], seed: int = SEED) -> np.ndarray:
    digest = xxhash.xxh64_digest
    joined = b"".join([digest(p, seed) for p in pieces])
    return np.frombuffer(joined, ">u8").astype(np.uint64)


def _majority(h: np.ndarray) -> int:
    """The fingerprint of hashes: a bit is 1 if set in over half of them; none gives zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 15):
        part = h[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words joined by spaces; a shorter text is one run, no words none."""
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0] + [e + 1 for e in ends[:-1]]
    return [joined[a:b] for a, b in zip(starts, ends[size - 1 :], strict=False)]


def fingerprint(text: str | None, size: int = 3) -> int:
    return _majority(_hashes(shingles(words_of(text), size)))


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprints(
    df: DataFrame,
    size: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    keyed: bool = False,
) -> DataFrame:
    """``doc_id`` and the 64-bit ``fingerprint`` of every whole text; NULL and empty give zero.

    ``keyed`` adds ``text_key``, a hash that tells the texts of one id apart.
    """
    more = [text_key(F.col(text_col)).alias("text_key")] if keyed else []
    names = ["doc_id", "fingerprint", *(["text_key"] if keyed else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t, size)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64()), *batch.columns[2:]], names=names
            )

    rows = df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), *more
    )
    return rows.mapInArrow(run, ", ".join(f"{name} bigint" for name in names))


def cell_keys(fp: Column, table: Column | int = 0) -> Column:
    """The ten keys of a fingerprint: two of its five bit blocks each, and which two."""
    at = [sum(_WIDTHS[:i]) for i in range(5)]
    block = [
        F.shiftrightunsigned(fp, at[i]).bitwiseAND(F.lit((1 << _WIDTHS[i]) - 1)) for i in range(5)
    ]
    pairs = [(i, j) for i in range(5) for j in range(i)]
    return F.array(
        *[
            F.shiftleft(F.lit(table).cast("bigint") * len(pairs) + k, 32)
            + F.shiftleft(block[i], 16)
            + block[j]
            for k, (i, j) in enumerate(pairs)
        ]
    )


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node it is connected with by the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def _links(
    group: np.ndarray, fp: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group within ``distance``: band, pivot table, then verification."""
    pivot = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((pivot[:, 0], group))
    group, fp, pivot = group[order], fp[order], pivot[order]
    first = pivot[:, 0].astype(np.int64)
    found_a, found_b = [], []
    rows, step = np.arange(len(fp) - 1), 1
    while len(rows):
        other = rows + step
        near = (group[other] == group[rows]) & (first[other] - first[rows] <= distance)
        rows, other = rows[near], other[near]
        spread = np.abs(pivot[rows] - pivot[other]).max(axis=1, initial=0)
        a, b = rows[spread <= distance], other[spread <= distance]
        same = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        a, b = order[a[same]], order[b[same]]
        found_a.append(a)
        found_b.append(b)
        step += 1
        rows = rows[rows + step < len(fp)]
    return np.concatenate(found_a or [rows]), np.concatenate(found_b or [rows])


def _whole_groups(found: Callable[[list[pa.RecordBatch]], pa.RecordBatch]) -> Callable:
    """For ``mapInArrow`` over rows sorted by their first column: ``found`` gets whole groups of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy()
            cut = int(np.searchsorted(group, group[-1]))  # where the last, perhaps open, group begins
            if cut or (held and held[-1].column(0)[-1].as_py() != group[0]):
                yield found([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield found(held)

    return run


def edges(nodes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Spanning edges (``a`` > ``b``) of the links between ``nodes``.

    ``nodes`` has ``node`` (bigint, unique) and ``fps`` (one or more fingerprints; nodes link when
    one of them does).
    """
    spark = nodes.sparkSession
    cells = nodes.select("node", F.posexplode("fps").alias("table", "fp")).select(
        "node", "fp", F.explode(cell_keys(F.col("fp"), F.col("table"))).alias("cell")
    )
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    shared = cells.join(sizes, "cell")
    chunks = F.greatest(
        F.least(F.ceil(F.col("n") / _SMALL), F.lit(_CHUNKS)), F.ceil(F.col("n") / _LARGE)
    ).cast("int")
    shared = shared.withColumn("chunks", chunks).withColumn(
        "chunk", F.pmod(F.hash("node"), F.col("chunks"))
    )
    shared = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    low, high = F.least("chunk", "other"), F.greatest("chunk", "other")
    rows = shared.select(
        F.xxhash64("cell", low, high).alias("group"),
        (F.col("chunk") < F.col("other")).cast("byte").alias("lower"),
        (low < high).alias("two"),
        "node",
        "fp",
    )

    def found(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        raw = table.column("group").to_numpy()
        group = np.cumsum(np.concatenate([[0], raw[1:] != raw[:-1]]))
        lower = table.column("lower").to_numpy()
        two = table.column("two").to_numpy()
        node = table.column("node").to_numpy()
        fp = table.column("fp").to_numpy().view(np.uint64)
        a, b = _links(group, fp, distance)
        inner = two[a] & (lower[a] == lower[b])
        within = _components(len(node), a[inner], b[inner])
        across = _components(len(node), a, b)
        heads = np.flatnonzero((within == np.arange(len(node))) & (across != within))
        x, y = node[heads], node[across[heads]]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"]
        )

    rows = rows.repartition(partitions(spark), "group").sortWithinPartitions("group")
    return rows.mapInArrow(_whole_groups(found), "a bigint, b bigint").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for every node with a link.

    ``links`` are distinct pairs ``a`` > ``b``. Large-star and small-star steps alternate until
    every node hangs on its root; each round is written, so that a lost executor repeats one round.
    """
    now = settle(links, "links")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("x"), "m").where("x <> m").unionByName(
            least.select(F.col("a").alias("x"), "m")
        )
        after = settle(small.select(F.col("x").alias("a"), F.col("m").alias("b")).distinct(), "links")
        # Done when no node is both hanging and hung upon, and none hangs on two.
        row = after.agg(F.count("*"), F.count_distinct("a")).first()
        roots = after.select(F.col("b").alias("a")).distinct()
        if row[0] == row[1] and after.join(roots, "a", "left_semi").isEmpty():
            return after.toDF("node", "root")
        now = after


def linked_documents(
    df: DataFrame, size: int = 3, distance: int = DISTANCE, id_col: str = "doc_id"
) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``distance`` bits or fewer, its own
    included. Texts without words have fingerprint zero and link like any other. Repeated rows and
    repeated ids stay as many rows; NULL ids are members without being the smallest (a component of
    NULL ids alone has NULL). An empty table stays empty.
    """
    prints = settle(fingerprints(df, size, id_col), "fingerprints")
    nodes = prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("least"))
    nodes = settle(nodes.withColumn("fps", F.array("node")), "nodes")
    roots = components(edges(nodes, distance))
    labelled = nodes.join(roots, "node", "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labelled.join(smallest, "root").select(
        F.col("node").alias("fingerprint"), "component_id"
    )
    return prints.join(labels, "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keep_one(
    df: DataFrame,
    size: int = 3,
    distance: int = DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``df`` with one row of each group of near-duplicates, the one with the smallest id.

    Groups are the components of ``linked_documents``: fingerprints of ``size``-word shingles that
    differ in ``distance`` bits or fewer are linked. Texts without words are one group. Of rows with
    the same smallest id the one with the smaller hash of its text stays, of wholly equal rows one.
    NULL ids are larger than any other. All columns stay as they are, whatever their names. An empty
    table stays empty.
    """
    id_, key, copies = fresh(df, "_kept_id", "_kept_text", "_copies")
    prints = settle(fingerprints(df, size, id_col, text_col, keyed=True), "fingerprints")
    nodes = prints.select(F.col("fingerprint").alias("node")).distinct()
    nodes = settle(nodes.withColumn("fps", F.array("node")), "nodes")
    roots = components(edges(nodes, distance))
    rows = prints.groupBy("fingerprint", "doc_id", "text_key").agg(F.count("*").alias("n"))
    rows = rows.join(roots, rows["fingerprint"] == roots["node"], "left")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key", "n")
    kept = rows.groupBy(F.coalesce("root", "fingerprint").alias("group")).agg(
        F.min(order).alias("kept")
    )
    kept = settle(
        kept.select(
            F.col("kept.doc_id").alias(id_),
            F.col("kept.text_key").alias(key),
            F.col("kept.n").alias(copies),
        ),
        "kept",
    )
    same = df[id_col].cast("bigint").eqNullSafe(kept[id_]) & (text_key(df[text_col]) == kept[key])
    if kept.where(F.col(copies) > 1).isEmpty():
        return df.join(kept, same, "left_semi")
    return df.join(kept, same).dropDuplicates([id_, key]).select(*df.columns)
