"""Decontamination and its FM-index against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import decontaminate, fmindex

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id bigint, text string"


def words(text):
    return SPLIT.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def windows(items, window):
    out = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            out.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    return out


def expected(rows, items, window=10):
    known = windows(items, window)
    sizes = {len(k) for k in known}
    out = Counter()
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                if (ids := known.get(tuple(w[at : at + size]))) is not None:
                    hit.update(range(at, at + size))
                    found |= ids
        out[(i, len(w), tuple(sorted(hit)), tuple(sorted(found)))] += 1
    return out


def found(df):
    out = Counter()
    for r in df.collect():
        hit = tuple(k for s in r.spans for k in range(s.begin, s.end))
        assert len(hit) == r.n_hit
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:]))
        out[(r.doc_id, r.n_words, hit, tuple(r["items"]))] += 1
    return out


def prose(seed, n, vocabulary=30):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def corpus():
    items = [(i, prose(i, 25)) for i in range(12)]
    items += [(20, "three short words"), (21, "three short words"), (None, "Ünder, ÜNDER"), (22, "")]
    items += [(23, None), (24, "w1"), (25, items[0][1]), (25, items[1][1])]
    rows = [(i, f"{prose(100 + i, 40)} {items[i % 12][1][: 20 + 7 * i]} {prose(i, 30)}") for i in range(40)]
    rows += [(50, "THREE, short... Words!"), (51, "under Ünder Ünder"), (52, items[3][1])]
    rows += [(53, f"{items[4][1]}\n{items[4][1]}"), (None, items[5][1]), (None, items[5][1]), (52, "w1")]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"shard_words": 50}, {"shard_words": 64, "block": 9}])
@pytest.mark.parametrize("window", [3, 10])
def test_spans_and_items(spark, documents, odd_texts, window, options):
    rows, items = corpus()
    rows += [(100 + i, t) for i, t in enumerate(odd_texts)]
    test = spark.createDataFrame(items, ITEM)
    got = decontaminate.contamination(documents(rows), test, window=window, **options)
    assert found(got) == expected(rows, items, window)


def test_copies_and_one_word_repeated(spark, documents):
    text = prose(1, 300, 5)
    rows = [(i, text) for i in range(40)] + [(90, "a " * 5000), (91, "a " * 3)]
    items = [(1, "a " * 12), (2, " ".join(text.split()[100:130]))]
    got = decontaminate.contamination(documents(rows), spark.createDataFrame(items, ITEM))
    assert found(got) == expected(rows, items)


def test_empty_tables(spark, documents):
    rows, items = corpus()
    none = spark.createDataFrame([], ITEM)
    assert decontaminate.contamination(documents([]), spark.createDataFrame(items, ITEM)).collect() == []
    assert found(decontaminate.contamination(documents(rows), none)) == expected(rows, [])


def test_texts_are_cut_and_other_columns_stay(spark, documents):
    rows = [
        (1, "Before. One, two THREE four; after"),
        (1, "One, two THREE four; after"),
        (2, "clean text stays\tas it is "),
        (3, None),
        (4, "é one two three four é one two three four"),
    ]
    items = spark.createDataFrame([(1, "one two three four")], ITEM)
    docs = documents(rows).selectExpr("*", "7 AS _row", "8 AS n_hit", "'s' AS spans")
    got = decontaminate.decontaminate(docs, items, window=4)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text, r._row, r.n_hit, r.spans) for r in got.collect()) == Counter(
        [
            (1, "Before. ; after", 7, 8, "s"),
            (1, "; after", 7, 8, "s"),
            (2, "clean text stays\tas it is ", 7, 8, "s"),
            (3, None, 7, 8, "s"),
            (4, "é  é ", 7, 8, "s"),
        ]
    )


def test_index_finds_every_place_of_every_phrase():
    draw = np.random.default_rng(5)
    texts = [draw.integers(1, 6, n) for n in (1, 40, 40, 7, 300, 2)]
    texts.append(texts[1])
    symbols = np.concatenate([np.append(t, 0) for t in texts]).astype(np.int32)
    built = fmindex.build(symbols, [b"a", b"b", b"c", b"d", b"e"], rate=8)
    index = fmindex.FMIndex.from_row(built.to_row())
    for size in (1, 2, 3, 5):
        phrases = draw.integers(0, 6, (60, size))
        alive, low, high = index.search(phrases)
        got = {int(k): np.sort(index.locate(np.arange(a, b))) for k, a, b in zip(alive, low, high)}
        for k, phrase in enumerate(phrases):
            at = [
                i
                for i in range(len(symbols) - size + 1)
                if (phrase > 0).all() and (symbols[i : i + size] == phrase).all()
            ]
            assert got.get(k, np.empty(0)).tolist() == at


def test_suffixes_are_in_order():
    draw = np.random.default_rng(6)
    for alphabet in (1, 2, 50):
        keys = np.append(draw.integers(1, alphabet + 1, 200), 0)
        order = fmindex.suffix_order(keys).tolist()
        assert order == sorted(range(len(keys)), key=lambda i: keys[i:].tolist())
