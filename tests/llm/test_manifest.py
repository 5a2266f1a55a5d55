"""Merkle manifests and proofs against a plain Python version."""

from __future__ import annotations

import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from strata.llm import manifest

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tampered(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 7 or row[3] is None:
        return row
    return (*row[:3], row[3] + 1, row[4])


def climb(level, at):
    """The root of a level and the siblings met from ``at``, with the side they are on."""
    met = []
    while len(level) > 1:
        pair = [i for i in (at & ~1, at | 1) if i < len(level)]
        met.append([(level[i], i < at) for i in pair if i != at])
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at //= 2
    return level[0], met


def fold(value, met):
    for others in met:
        left = [x for x, before in others if before]
        right = [x for x, before in others if not before]
        value = h(*left, value, *right)
    return value


def expected(rows):
    def byte(v):
        return (v is not None, (v or "").encode())

    groups = {}
    for row in sorted(rows, key=lambda r: (byte(r[2]), r[0] is not None, r[0] or 0, leaf(r))):
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=byte)
    roots = [climb([leaf(r) for r in groups[g]], 0)[0] for g in order]
    out = Counter()
    for k, g in enumerate(order):
        leaves = [leaf(r) for r in groups[g]]
        root, above = climb(roots, k)
        for i, row in enumerate(groups[g]):
            met = climb(leaves, i)[1] + above
            folded = fold(leaf(tampered(row)), met)
            proof = h(*[x for others in met for x, _ in others])
            out[(row[0], leaves[i], roots[k], root, proof, folded, folded == root)] += 1
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    odd = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    claimed = F.when(odd, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    built = manifest.build(df, COLUMNS, "doc_id", "lang", {"n_chars": claimed}, **options)
    names = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return Counter(tuple(r[c] for c in names) for r in manifest.prove(built).collect())


def documents(n, langs=("en", "de", None, "", "é", "z")):
    return [(i, f"src{i % 3}", langs[i * i % len(langs)], 10 * i, f"text {i}") for i in range(n)]


@pytest.mark.parametrize(("n", "bits"), [(1, 8), (2, 1), (3, 2), (37, 1), (90, 2), (300, 8)])
def test_proofs(spark, n, bits):
    assert found(spark, documents(n), bits=bits) == expected(documents(n))


@pytest.mark.parametrize("n", [4, 5, 16, 17])
def test_levels_around_whole_runs(spark, n):
    rows = documents(n, ("en",))
    assert found(spark, rows, bits=2) == expected(rows)


def test_many_groups_of_one_leaf(spark):
    rows = [(i, None, f"lang{i:03d}", i, None) for i in range(70)]
    assert found(spark, rows, bits=3) == expected(rows)


def test_odd_values(spark, odd_texts):
    rows = [(i, None, "en", None, t) for i, t in enumerate(odd_texts)]
    rows += [(None, "a", None, 3, "x"), (None, "b", None, 4, "y"), (3, "s", "en", 5, "again")] * 2
    rows += [(k, "-", "1:a", 2**62, "3:abc") for k in range(20)]
    assert found(spark, rows, bits=2) == expected(rows)


def test_empty_table_and_more_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    built = manifest.build(df, COLUMNS, "doc_id", "lang")
    assert built.root is None
    assert manifest.prove(built).collect() == []
    rows = documents(20)
    more = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS id", "2 AS tree", "'x' AS claimed", "3 AS hash", "4 AS grp"
    )
    proofs = manifest.prove(manifest.build(more, COLUMNS, "doc_id", "lang")).collect()
    assert {r.root for r in proofs} == {next(iter(expected(rows)))[3]}
    assert all(r.verified for r in proofs)


def test_row_limit_of_the_session_is_kept(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        assert found(spark, documents(60)) == expected(documents(60))
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "50"
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)
