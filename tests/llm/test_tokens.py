"""Token ids, their files, and packing, against the library used plainly."""

from __future__ import annotations

import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import grammar, packing
from strata.llm.encoding import Encoder
from strata.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library, odd_texts):
    r = random.Random(3)
    letters = list("abXY  \n\n\t'sdre129,.!é中\u2003…“\u0085Ა<|>")
    texts = [t or "" for t in odd_texts]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(2000)]
    end = "<|endoftext|>"
    texts += [end, end + end, f"one {end} two", f"{end} first", f"last {end}", f"glued{end}glued", "<|endof"]
    texts += ["text|>", f"with\ttab {end}", f"{end}\n{end} ", "no <|endoftext> token"]
    small = Encoder(tokenizer_path(), limit=50)
    for encoder in (Encoder(tokenizer_path()), small):
        for _ in range(2):
            assert encoder.lists(texts) == [library(t) for t in texts]


def test_added_tokens_have_their_own_id(library):
    assert Encoder(tokenizer_path()).lists(["one <|endoftext|> two"]) == [[505, 220, 50256, 734]]
    assert library("one <|endoftext|> two") == [505, 220, 50256, 734]


def test_memory_of_the_encoder_does_not_grow_with_the_batch():
    r = random.Random(5)
    texts = [" ".join(f"w{r.randint(0, 30_000)}" for _ in range(500)) for _ in range(2500)]
    batch = pa.array(texts)
    encode = Encoder(tokenizer_path())
    tracemalloc.start()
    try:
        flat, sizes = encode.encode(batch)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(sizes) == len(texts) and sizes.sum() == len(flat)
    assert peak - 3 * flat.nbytes < 64e6  # 237 MB in stretches of 4 MB


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_grammar_round_trip_and_random_access(n):
    r = np.random.default_rng(n)
    ids = (r.zipf(1.3, n) % 300).astype(np.uint32)
    symbols, rules = grammar.compress(ids, 300)
    low, high = grammar.pack(symbols)
    symbols = grammar.unpack(low, high, len(symbols))
    assert (grammar.decode(symbols, rules, 300) == ids).all()
    if n > 10_000:
        assert len(rules) and len(symbols) < n
    for start in range(0, n, max(1, n // 20)):
        assert (grammar.decode(symbols, rules, 300, start, 77) == ids[start : start + 77]).all()


def test_equal_ids_are_replaced_without_overlap():
    ids = np.full(5001, 7, np.uint32)
    symbols, rules = grammar.compress(ids, 300)
    assert len(symbols) < 400 and (grammar.decode(symbols, rules, 300) == ids).all()


@pytest.mark.parametrize("repeats, least_per_symbol", [(1, 1), (40, 15), (1000, 250)])
def test_rounds_go_on_until_no_pair_is_frequent(repeats, least_per_symbol):
    passage = np.random.default_rng(3).integers(0, 300, 2000).astype(np.uint32)
    ids = np.tile(passage, repeats)
    symbols, rules = grammar.compress(ids, 300)
    pairs = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True))
    assert max(pairs.values()) < grammar.FREQUENT
    assert len(ids) >= least_per_symbol * len(symbols)
    assert (grammar.decode(symbols, rules, 300) == ids).all()


@pytest.mark.parametrize("shard", [40, 1 << 21])
def test_a_range_is_what_the_whole_has_there(spark, documents, odd_texts, library, tmp_path, shard):
    texts = [*odd_texts, *["the same few words again"] * 30]
    path = str(tmp_path / "ids")
    grammar.write_ids(documents(texts), path, tokenizer_path(), shard_tokens=shard)
    whole = [x for t in texts for x in (*library(t), 0)]
    for start, count in [(0, 5), (len(whole) - 3, 50), (7, 400), (0, len(whole)), (len(whole), 9), (3, 0)]:
        rows = grammar.read_range(spark, path, start, count).orderBy("start").collect()
        assert [x for r in rows for x in r.ids] == whole[start : start + count]
        at = start
        for r in rows:
            assert r.start == at
            at += len(r.ids)


def test_only_needed_rules_are_expanded(monkeypatch):
    ids = np.tile(np.arange(50, dtype=np.uint32), 2000)
    symbols, rules = grammar.compress(ids, 300)
    lengths = grammar.rule_lengths(rules, 300)
    assert int(lengths[symbols[symbols >= 300] - 300].sum() + (symbols < 300).sum()) == len(ids)
    monkeypatch.setattr(grammar, "rule_lengths", None)  # stored lengths are enough
    assert (grammar.decode(symbols, rules, 300, 999, 3, lengths) == ids[999:1002]).all()


@pytest.mark.parametrize("shard", [50, 1 << 21])
def test_files_give_back_every_document(spark, documents, odd_texts, library, tmp_path, shard):
    docs = documents([(1000 - 7 * i, t) for i, t in enumerate(odd_texts)] + [(None, "no id")])
    path = str(tmp_path / "ids")
    grammar.write_ids(docs, path, tokenizer_path(), shard_tokens=shard)
    found = [tuple(r) for r in grammar.read_ids(spark, path).orderBy("start").collect()]
    rows = sorted(((d.doc_id, d.text) for d in docs.collect()), key=lambda r: (r[0] is not None, r))
    wanted, start = [], 0
    for doc_id, text in rows:
        ids = [*library(text), 0]
        wanted.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert found == wanted


def test_empty_table_has_no_ids(documents):
    assert grammar.through_files(documents([]), tokenizer_path()).count() == 0
    assert packing.pack(packing.pieces(documents([]), tokenizer_path())).count() == 0


def test_pieces_are_packed_without_gap_or_loss(documents, odd_texts, library):
    docs = documents(odd_texts + [(3, "a repeated id")] + ["few words here"] * 40)
    rows = packing.pack(packing.pieces(docs, tokenizer_path(), capacity=64), 64).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    wanted = []
    for d in docs.collect():
        ids = [*library(d.text), 2]
        stop, start, piece = (len(ids) - 1) % 64 + 1, 0, 0
        while start < len(ids):
            wanted.append((d.doc_id, piece, start, stop - start, crc(ids[start:stop])))
            start, stop, piece = stop, stop + 64, piece + 1
    assert sorted(tuple(r)[:5] for r in rows) == sorted(wanted)
    for members in by_sequence.values():
        at = 0
        for row in sorted(members, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 64
    least = -(-sum(r.length for r in rows) // 64)
    assert len(by_sequence) <= least + 2


def best_fit_decreasing(sizes, capacity):
    gaps: list[int] = []
    for s in sorted(sizes, reverse=True):
        fit = [g for g in gaps if g >= s]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - s)
    return len(gaps)


def of_sizes(spark, sizes):
    rows = [(i, 0, 0, s, i) for i, s in enumerate(sizes)]
    return spark.createDataFrame(rows, packing.PIECES)


@pytest.mark.parametrize("rows_per_task", [40, packing.ROWS_PER_TASK])
@pytest.mark.parametrize("kind", ["any", "short", "hot"])
def test_supersteps_need_no_more_sequences_than_best_fit(spark, kind, rows_per_task):
    r = random.Random(5)
    top = {"any": 40, "short": 6, "hot": 40}[kind]
    sizes = [r.randint(1, top) for _ in range(300)]
    if kind == "hot":
        sizes[:150] = [13] * 150
    rows = packing.pack(of_sizes(spark, sizes), 40, rows_per_task).collect()
    assert sorted((row.doc_id, row.length) for row in rows) == list(enumerate(sizes))
    used = defaultdict(list)
    for row in rows:
        used[row.sequence_id].append((row.offset, row.length))
    for places in used.values():
        places.sort()
        ends = [0, *(offset + length for offset, length in places)]
        assert [offset for offset, _ in places] == ends[:-1] and ends[-1] <= 40
    assert len(used) <= best_fit_decreasing(sizes, 40) + 1


def test_a_gap_takes_the_largest_document_below_it():
    size = np.array([1, 3, 3, 4, 5, 5, 6, 9])
    slot = np.array([0, 0, 1, 0, 0, 1, 1, 1], bool)
    docs, slots = packing._matched(slot)
    taken = {int(size[s]): int(size[d]) for d, s in zip(docs, slots, strict=True)}
    assert taken == {3: 3, 5: 5, 6: 4, 9: 1}


def test_ranges_hand_on_what_they_could_not_match():
    left = {0: (5, 0), 1: (2, 3), 3: (0, 3)}  # documents and slots left
    runs = packing.across(left)
    pairs = {}
    for part, lo, hi, other, at, first in runs:
        count = hi - lo + 1
        for j in range(count):
            pairs[other, at + j] = (part, hi - j, first + j)
    assert pairs == {
        (1, 0): (0, 4, 0), (1, 1): (0, 3, 1), (1, 2): (0, 2, 2),
        (3, 0): (1, 1, 3), (3, 1): (1, 0, 4), (3, 2): (0, 1, 5),
    }
