"""The pipeline stage by stage, each against what its rule says about its own input."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from strata.llm.common import settle
from tests.llm.test_native import deduped, measures
from tests.llm.test_simhash import survivors


def corpus():
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(r.randint(3, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = "All of this line stands in very many documents of the corpus"
    texts = []
    for i in range(60):
        texts.append("\n".join([prose(r.randint(60, 200)), shared if i % 3 == 0 else prose(9)]))
    copies = {}
    for i in range(0, 20, 2):
        words = texts[i].split(" ")
        words[r.randrange(len(words))] = word()
        copies[len(texts)] = i
        texts.append(" ".join(words))
    texts += [texts[1], "too short", None, "", "SHOUTING WORDS " * 20, "same words again " * 30]
    return texts, copies


@pytest.fixture(scope="module")
def stages(spark):
    texts, copies = corpus()
    rows = [(i, t, "en", f"src{i % 2}", None if t is None else len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], ""), "stage"))
    return out, copies


def test_columns_stay_until_packing(stages):
    out, _ = stages
    assert [d.columns for d in out[1:-1]] == [out[0].columns] * 4


def test_rules_reject_what_they_say(stages):
    out, _ = stages
    kept = {r.doc_id for r in out[1].collect()}
    for row in out[0].collect():
        n, chars, symbols, lines, dup, repeat = measures(row.text)
        text = row.text or ""
        bad = n < 10 or 100 * repeat > 20 * n or 10 * symbols > n or 2 * dup > lines
        bad = bad or chars < 2 * n or chars > 15 * n
        bad = bad or 2 * sum(c.isupper() for c in text) > sum(c.isalpha() for c in text)
        assert (row.doc_id in kept) == (not bad)


def test_lines_go_as_in_brute_force(stages):
    out, _ = stages
    before = [(r.doc_id, r.text) for r in out[1].collect()]
    after = {r.doc_id: r.text for r in out[2].collect()}
    assert after == dict(deduped(before))
    assert all(r.n_chars == len(r.text) for r in out[2].collect())


def test_one_of_each_group_stays(stages):
    out, _ = stages
    before = [(r.doc_id, r.text) for r in out[2].collect()]
    after = {r.doc_id for r in out[3].collect()}
    assert after == {doc_id for _, doc_id, _ in survivors(before)}
    assert len(before) > len(after) >= 55


def test_odd_tables_go_through_all_stages(spark, odd_texts):
    """Empty tables, NULLs in every column, repeated rows and more columns with clashing names."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, t, None, None, None) for i, t in enumerate(odd_texts)]
    rows += [(None, t, None, "src0", 5) for t in corpus()[0][:12] * 2]
    for given in ([], rows):
        docs = spark.createDataFrame(given, schema).selectExpr("*", "'k' AS k1", "1 AS line", "2 AS node")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = settle(stage(spark, docs, ""), "stage")
            assert after.columns == docs.columns
            docs = after
        packed = settle(corpus_pipeline.STAGES[-1][1](spark, docs, ""), "stage")
        assert (packed.count() > 0) == bool(given)


def test_mix_repeats_whole_documents(stages):
    out, _ = stages
    known = {(r.doc_id, r.text) for r in out[3].collect()}
    assert {(r.doc_id, r.text) for r in out[4].collect()} <= known


def test_packing_holds_every_document(stages):
    out, _ = stages
    wanted = Counter(r.doc_id for r in out[4].collect())
    rows = out[5].collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == wanted
    sequences = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == sequences[r.sequence_id]
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 1024
