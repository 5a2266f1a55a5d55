"""Fingerprints, links and groups against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash


def plain_fingerprint(text, size):
    words = [w for w in "".join(
        c.lower() if c.isascii() else c for c in (text or "")
    ).replace("\n", " ").replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace(
        "\x0c", " ").split(" ") if w]
    runs = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def reachable(nodes, near):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if near(a, b) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_fingerprint_is_the_plain_one(odd_texts):
    for text in odd_texts:
        for size in (1, 3, 5):
            assert simhash.fingerprint(text, size) == plain_fingerprint(text, size)


def test_hash_is_that_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c")).alias("h")).first()
    assert row.h % 2**64 == int(simhash._hashes([b"a b c"])[0])


@pytest.mark.parametrize("small", [2, 256])
def test_links_equal_brute_force(spark, monkeypatch, small):
    """Chains, cells with many fingerprints (chunks of ``small``) and unlinked ones."""
    monkeypatch.setattr(simhash, "_SMALL", small)
    r = random.Random(small)
    fps = set()
    for _ in range(12):
        at = r.getrandbits(64)
        for _ in range(12):
            fps.add(at)
            for bit in r.sample(range(64), r.randint(1, 4)):
                at ^= 1 << bit
    fps = [simhash._signed(f) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in fps], "node bigint").withColumn(
        "fps", F.array("node")
    )
    found = {r.node: r.root for r in simhash.components(simhash.edges(nodes)).collect()}
    near = lambda a, b: ((a ^ b) % 2**64).bit_count() <= 3
    root = reachable(fps, near)
    # edges come from both sides of equal components: compare the partition, not only the roots
    assert {n: found.get(n, n) for n in fps} == root


def test_documents_with_odd_rows(documents, odd_texts):
    near = "alpha beta gamma delta " * 50
    docs = documents(
        odd_texts + [near, near + "epsilon", (0, "a repeated id"), (None, near), (None, "lonely")]
    )
    rows = simhash.linked_documents(docs).collect()
    assert len(rows) == docs.count()
    wanted = sorted(
        (f"{plain_fingerprint(d.text, 3):016x}", d.doc_id is None, d.doc_id or 0)
        for d in docs.collect()
    )
    assert sorted((r.fingerprint, r.doc_id is None, r.doc_id or 0) for r in rows) == wanted
    fps = [int(r.fingerprint, 16) for r in rows]
    root = reachable(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 3)
    for row in rows:
        same = [
            r.doc_id
            for r in rows
            if root[int(r.fingerprint, 16)] == root[int(row.fingerprint, 16)]
            and r.doc_id is not None
        ]
        assert row.component_id == min(same, default=None)


def test_empty_table(documents):
    assert simhash.linked_documents(documents([])).count() == 0
    assert simhash.keep_one(documents([])).count() == 0


def survivors(rows, size=3):
    """Brute force: of each component the row with the smallest id, NULL ids last."""
    fps = [plain_fingerprint(text, size) for _, text in rows]
    root = reachable(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for (doc_id, text), fp in zip(rows, fps, strict=True):
        groups.setdefault(root[fp], []).append((doc_id is None, doc_id or 0, text))
    return [min(g, key=lambda r: r[:2]) for g in groups.values()]


def test_one_of_each_group_stays(documents):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(3, 9)))
    texts = []
    for i in range(60):
        words = [word() for _ in range(r.randint(200, 600))]
        texts.append(" ".join(words))
        for _ in range(i % 4):
            copy = list(words)
            for _ in range(i % 3):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rows = [*enumerate(texts), (900, texts[0]), (901, None), (902, ""), (None, texts[5]), (None, "alone here")]
    docs = documents(rows).selectExpr("*", "1 AS _kept_id", "2 AS node", "3 AS fingerprint")
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted((x.doc_id is None, x.doc_id or 0, x.text) for x in kept.collect())
    assert [f[:2] for f in found] == sorted(w[:2] for w in survivors(rows))
    assert 60 <= len(found) < len(rows) - 30


def test_ties_and_repeated_rows_leave_one(documents):
    text = "some words that stand in every one of these rows " * 3
    assert simhash.keep_one(documents([(1, text), (1, text), (1, text + "  "), (2, text)])).count() == 1
    assert [x.doc_id for x in simhash.keep_one(documents([(None, text), (None, text)])).collect()] == [None]
    kept = simhash.keep_one(documents([(None, text), (4, text)])).collect()
    assert [x.doc_id for x in kept] == [4]
