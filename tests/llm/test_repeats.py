"""Repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strata.llm import repeats


def brute(texts):
    data = [(t or "").encode() for t in texts]
    windows = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 199):
            if windows[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgéç") for _ in range(r.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (30, 45, 60, 200)]
    texts = []
    for i in range(60):
        parts = [prose(r.randint(0, 60))]
        for _ in range(r.randint(0, 2)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            parts += [p[a:], prose(r.randint(0, 30))]
        texts.append(" ".join(parts))
    texts += [texts[0], texts[3], texts[3] + "!", texts[5][: len(texts[5]) // 2]]
    near = list(passages[3])
    for _ in range(4):
        near[r.randrange(len(near))] = "#"
        texts.append("".join(near))
    texts += ["ab" * 400, "lonely, and lonelier still; " * 40, "x" * 250, "x" * 200, "x" * 199, "y" * 200, "q " * 3000]
    return texts


def rows_of(docs):
    found = repeats.remove_repeats(docs).collect()
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans,
         repeats.digest(bytes(r.kept)))
        for r in found
    )


@pytest.mark.parametrize("crowd", [1 << 20, 900])
def test_equals_brute_force(documents, odd_texts, monkeypatch, crowd):
    """Also with nearly all anchors too crowded for an index."""
    monkeypatch.setattr(repeats, "CROWD_BYTES", crowd)
    texts = odd_texts + corpus(crowd)
    assert rows_of(documents(texts)) == sorted(
        (False, i, *row) for i, row in enumerate(brute(texts))
    )


def test_repeated_rows_and_ids(documents):
    texts = ["z" * 50 + str(i) * 150 for i in range(3)]
    docs = documents([(1, texts[0]), (1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[0])])
    plain = brute([texts[0], texts[0], texts[1], texts[2], texts[0]])
    ids = [1, 1, 1, None, None]
    assert rows_of(docs) == sorted(
        (i is None, i or 0, *row) for i, row in zip(ids, plain, strict=True)
    )


def test_empty_table(documents):
    assert repeats.remove_repeats(documents([])).count() == 0


def test_suffixes_and_statistics():
    r = random.Random(4)
    for alphabet in ("a", "ab", "abcd"):
        texts = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 120))).encode()
                 for _ in range(12)]
        texts.append(texts[0])
        index = repeats.RunIndex(texts)
        suffixes = [t[i:] for t in texts for i in range(len(t))]
        order = repeats.suffix_order(index.data, index.ends)
        assert [suffixes[i] for i in order] == sorted(suffixes)
        assert index.runs.sum() == len(suffixes)
        ranked = sorted(range(len(suffixes)), key=lambda i: (suffixes[i], i))
        share = lambda a, b: next(
            (k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b))
        )
        wanted = [0] * len(suffixes)
        for a, b in zip(ranked, ranked[1:], strict=False):
            n = share(suffixes[a], suffixes[b])
            wanted[a], wanted[b] = max(wanted[a], n), max(wanted[b], n)
        assert index.matching_statistics().tolist() == wanted


def test_the_largest_id_is_not_the_unknown_one(documents):
    last = 2**63 - 1
    rows = [(last, "x" * 300), (None, "x" * 300), (None, "short"), (last, None)]
    found = repeats.remove_repeats(documents(rows)).collect()
    got = sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in found)
    assert got == [(False, 0, 0), (False, 300, 300), (True, 5, 0), (True, 300, 300)]
