"""Quality rules, line dedup, fingerprints, mixing and chat formatting on small, odd tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strata.llm import chat, fingerprint, lines, mixing, quality
from strata.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


# --- quality rules


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {
        i + k
        for i in range(len(words) - 4)
        if windows[tuple(words[i : i + 5])] > 1
        for k in range(5)
    }
    rows = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(rows), len(rows) - len(set(rows)), len(hit),
    )


def test_measures(documents, odd_texts):
    texts = odd_texts + [
        "a b c d e a b c d e f", "x " * 9, "l one\nl two\nl one\n\n \nl one", "# * $ %% words", "a b c d e",
        "p q r s t u v w x y " * 3 + "end", "Aa\x0bBb\x0cCc\tDd\rEe",
    ]
    docs = documents(texts)
    found = quality.measure(docs, groups=("words", "symbols", "lines", "repeats")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in sorted(found, key=lambda r: r.doc_id)] == [
        measures(t) for t in texts
    ]


def test_order_of_rules_never_changes_what_stays(documents, odd_texts):
    clean = "Every word of this plain sentence is said only once, as it should be here."
    docs = documents([clean, "WORD " * 3 + clean.upper(), "same line\n" * 20, *odd_texts])
    rules = quality.BASE_RULES + quality.PRODUCTION_RULES
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert 0 in kept and not kept & {1, 2, 3}
    text = F.coalesce("text", F.lit(""))
    for order in (rules, rules[::-1]):
        passed = docs
        for rule in order:
            passed = passed.where(~quality.rejecting(rule, text))
        assert {r.doc_id for r in passed.collect()} == kept
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(documents([])).count() == 0


def test_cheap_and_selective_rules_come_first(documents):
    never = quality.Rule("never", ("repeats",), lambda m: m("n_repeat_words") < 0)
    always = quality.Rule("always", ("words",), lambda m: m("n_words") >= 0)
    ordered = quality.order_rules(documents(["a b c d e f g"] * 50), "text", (never, always))
    assert [r.name for r in ordered] == ["always", "never"]


def test_clashing_columns_stay(spark):
    rows = [("this plain text has more than ten words and none twice", 7, "y", 1)]
    docs = spark.createDataFrame(rows, "text string, n_words long, rejected_by string, _words long")
    assert [tuple(r) for r in quality.keep_good(docs).collect()] == rows


# --- line dedup


def deduped(rows):
    """Greedy brute force: every line against every earlier first occurrence."""
    seen, out = [], []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    known = {}
    for i in order:
        kept = []
        for line in (rows[i][1] or "").split("\n"):
            words = set(WORD.findall(line))
            if not words:
                kept.append(line)
                continue
            if line in known:
                continue
            known[line] = True
            if not any(9 * len(words & s) >= 4 * (len(words) + len(s)) for s in seen):
                kept.append(line)
            seen.append(words)
        out.append((rows[i][0], None if rows[i][1] is None else "\n".join(kept)))
    return out


def test_lines_equal_brute_force(documents, odd_texts):
    base = "one two three four five six seven eight nine ten"
    texts = [
        base, base + " eleven", base + " eleven twelve thirteen", "ten nine eight seven six five four three two one",
        "\n\nkeep me\n\nkeep me\n", "a b c d e", "a b c d f", "a b c d", "A b c d e", "", None, "x", "x y", "x",
        "\n".join(f"{base} {i}" for i in range(30)), "tab\tparted words\x0bof a line", "tab parted words of a line",
        " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(20, 310)),
        *odd_texts,
    ]
    docs = documents(texts)
    found = lines.dedup_lines(docs, removed_col="gone").collect()
    assert sorted((r.doc_id, r.text) for r in found if r.text is not None) == sorted(
        (i, t) for i, t in deduped(list(enumerate(texts))) if t is not None
    )
    assert sum(r.text is None for r in found) == sum(t is None for t in texts)
    assert lines.dedup_lines(docs).columns == docs.columns


def test_lines_of_repeated_rows_and_clashing_columns(spark):
    rows = [(1, "same\nother", "p"), (1, "same\nother", "q"), (2, "same", "r"), (None, "same\nlast", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k1 string")
    found = {(r.doc_id, r.text, r._k1) for r in lines.dedup_lines(docs).collect()}
    assert found == {
        (1, "same\nother", "p"), (1, "same\nother", "q"), (2, "", "r"), (None, "last", "s"),
    }
    assert lines.dedup_lines(docs.where("false")).count() == 0


def test_words_of_a_line_are_made_once_a_step(documents):
    docs = documents(["a few words\nand more words", "a few words"])
    keys = lines._keys(docs, "doc_id", "text", True)
    found = lines.kept_lines(docs.select(*keys, "text"))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("regexp_replace" in step for step in plan)
    assert not any("Filter" in step and "regexp_replace" in step for step in plan)
    assert not any("lambdafunction(split(" in step for step in plan)


def test_sets_of_words_are_made_outside_lambda_functions(spark):
    texts = ["b a b", " a  b ", "tab\tand\x0bb", "", " ", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, line string")
    frequency = F.array(*[F.lit(0).cast("bigint")] * (1 << (lines.RARITY_BITS - 4)))
    made = lines._tokens(rows, frequency)
    found = {r.k: r for r in made.collect()}
    assert [found[k].n for k in range(6)] == [2, 2, 3, 0, 0, 0]
    assert all(len(r.tokens) == r.n and list(r.tokens) == sorted({*r.tokens}) for r in found.values())
    assert found[0].tokens == found[1].tokens
    tokens = made.schema["tokens"]
    assert not tokens.nullable and not tokens.dataType.containsNull
    plan = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert any("array_except(transform(" in step for step in plan)
    assert not any("transform(array_" in step for step in plan)
    assert sum("regexp_replace" in step for step in plan) == 1


def test_rare_words_come_first(documents):
    others = " ".join(f"w{i}" for i in range(40))
    docs = documents(["often " * 50 + "seldom", *[others] * 9])
    text = F.array(F.xxhash64(F.lit("often")), F.xxhash64(F.lit("seldom")))
    ordered = docs.select(lines._ordered(text, lines.rarity(docs)).alias("w"), text.alias("h"))
    row = ordered.first()
    kept = 2**61 - 1
    assert [w & kept for w in row.w] == [h % 2**64 >> 3 for h in reversed(row.h)]


def test_long_lines_are_told_apart_by_two_sketches(spark):
    r = random.Random(8)
    rows, similar = [], set()
    for k in range(300):
        a = [f"a{k}w{i}" for i in range(r.choice([20, 70, 79, 80, 81, 90, 110, 130]))]
        b = a[: r.randint(0, len(a))] if k % 2 else a[: len(a) - len(a) // 12]
        b += [f"b{k}w{i}" for i in range(len(a) - len(b) if k % 3 else len(a) // 12)]
        if 9 * len({*a} & {*b}) >= 4 * (len(a) + len(b)):
            similar.add(k)
        rows.append((k, " ".join(a), " ".join(b)))
    rows.append((300, " ".join(f"c{i}" for i in range(130)), " ".join(f"d{i}" for i in range(130))))
    pairs = spark.createDataFrame(rows, "k int, a string, b string")
    frequency = F.array(*[F.lit(0).cast("bigint")] * (1 << (lines.RARITY_BITS - 4)))

    def side(name):
        made = lines._tokens(pairs.select("k", F.col(name).alias("line")), frequency)
        tokens = F.col("tokens")
        second = lines._second_sketch(tokens, F.col("n")).alias("second")
        return made.select("k", "n", lines._sketch(tokens).alias("sketch"), second).alias(name)

    both = side("a").join(side("b"), F.expr("a.k = b.k"))
    one = {x.k for x in both.where(lines._apart(["sketch"])).select("a.k").collect()}
    two = {x.k for x in both.where(lines._HALVES_APART).select("a.k").collect()}
    assert similar <= one & two and len(similar) > 100
    assert 300 not in two


def test_a_rare_word_is_not_taken_for_a_frequent_one_of_a_similar_hash(spark, documents):
    often = F.xxhash64(F.lit("often"))
    words = spark.range(2_000_000).select(F.concat(F.lit("r"), "id").alias("w"))
    h = F.xxhash64("w")
    like = words.where(h.bitwiseAND(F.lit(2**15 - 1)) == often.bitwiseAND(F.lit(2**15 - 1)))
    like = like.where(h.bitwiseAND(F.lit(2**17 - 1)) != often.bitwiseAND(F.lit(2**17 - 1)))
    # By the hash alone it comes last.
    rare = like.where(F.shiftrightunsigned(h, 3) > F.shiftrightunsigned(often, 3)).first().w
    others = " ".join(f"w{i}" for i in range(100))
    docs = documents([f"{'often ' * 50}{rare}", *[others] * 9])
    both = F.array(often, F.xxhash64(F.lit(rare)))
    row = docs.select(lines._ordered(both, lines.rarity(docs)).alias("w"), both.alias("h")).first()
    assert [w & (2**61 - 1) for w in row.w] == [h % 2**64 >> 3 for h in reversed(row.h)]


# --- fingerprints


def test_fingerprints_of_odd_rows(documents, odd_texts):
    rows = [(9, "repeated"), (9, "repeated"), (None, "no id"), *enumerate(odd_texts)]
    found = fingerprint.edited_likeness(documents(rows)).collect()
    assert len(found) == len(rows)
    order = sorted(
        rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode())
    )
    wanted = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        wanted[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == wanted
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


@pytest.mark.parametrize("per", [1, 3, 1000])
def test_next_is_the_same_for_any_ranges(documents, per):
    texts = [(3 * i, f"text {i}") for i in range(50)]
    rows = documents(texts).select("doc_id", "text")
    found = fingerprint.with_next(rows, "doc_id", "text", "after", per).collect()
    assert {r.doc_id: r.after for r in found} == {
        3 * i: f"text {(i - 1) % 50}" for i in range(50)
    }
    assert fingerprint.with_next(rows.where("false"), "doc_id", "text", "after").count() == 0


def test_branches_locate_edits(spark):
    old = "\n".join(f"paragraph number {i}" for i in range(20))
    new = old.replace("number 3", "numeral 3").replace("number 17", "numeral 17")
    df = spark.createDataFrame([(old, new), (old, old)], "a string, b string")
    df = fingerprint.fingerprints(fingerprint.fingerprints(df, "a", "fa"), "b", "fb")
    rows = df.select(fingerprint.differing(F.col("fa"), F.col("fb")).alias("at")).collect()
    assert [r["at"] for r in rows] == [[3, 17], []]


def test_texts_with_the_same_leaf_digest_differ_in_their_roots(spark):
    met, i = {}, 0
    while (key := hashlib.md5(f"leaf {i}".encode()).hexdigest()[:8]) not in met:
        met[key], i = i, i + 1
    pair = [f"leaf {met[key]}", f"leaf {i}"]
    df = spark.createDataFrame([(t,) for t in pair], "text string")
    one, other = (r.fingerprint.split(";") for r in fingerprint.fingerprints(df).collect())
    assert one[3] == other[3]
    assert one[0] != other[0]


def test_every_inner_node_hashes_the_nodes_below_it(spark, odd_texts):
    texts = [*odd_texts, "\n".join(f"paragraph {i}" for i in range(20))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in fingerprint.fingerprints(df).collect():
        root, sections, paragraphs, _ = row.fingerprint.split(";")
        below = [hashlib.md5(p.encode()).hexdigest() for p in (row.text or "").split("\n")]
        above = [
            hashlib.md5(",".join(below[i : i + 8]).encode()).hexdigest()
            for i in range(0, len(below), 8)
        ]
        assert paragraphs == ",".join(below)
        assert sections == ",".join(above)
        assert root == hashlib.sha256(",".join(above).encode()).hexdigest()


# --- mixing


def test_mixing_meets_the_weights(documents):
    n = 4000
    docs = documents(["t"] * n, ["hot" if i % 3 else f"s{i % 9}" for i in range(n)])
    weights = {"hot": 1.0, "s0": 1.0, "s3": 1.0, "s6": 1.0, "absent": 9.0}
    mixed = mixing.mix(docs, weights, copy_col="copy", order_col="at")
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    for got in counts.values():
        assert abs(got - n / 4) < 5 * math.sqrt(n / 4)
    again = mixing.mix(docs, weights, copy_col="copy", order_col="at").collect()
    assert sorted(mixed.collect()) == sorted(again)
    at = [r["at"] for r in again]
    assert at == sorted(at) and len(set(at)) == len(at)


def test_mixing_with_a_large_mean_and_odd_rows(documents):
    docs = documents(["a", None, "", "b"], ["x", "x", None, "y"])
    mixed = mixing.mix(docs, {"x": 1.0, "y": 1.0}, total=4000)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"x", "y"} and all(abs(c - 2000) < 250 for c in counts.values())
    assert mixing.mix(documents([]), {"x": 1.0}).count() == 0
    assert mixed.columns == docs.columns
    rest = mixing.mix(docs, {"x": 1.0}, total=3000, rest_weight=2.0)
    counts = Counter(r.source for r in rest.collect())
    assert set(counts) == {"x", "y", None} and abs(counts["x"] - 1000) < 200


def test_mixing_with_clashing_names(documents):
    docs = documents(["a", "b"] * 20, ["x", "y"] * 20).selectExpr(
        "*", "1 AS _u_key", "2 AS copy", "3 AS _key", "4 AS _first", "5 AS shuffle_key"
    )
    mixed = mixing.mix(docs, {"x": 1.0, "y": 1.0}, copy_col="copy", order_col="shuffle_key")
    assert mixed.columns == [*docs.columns, "copy_", "shuffle_key_"]
    assert all((r._u_key, r["copy"], r._key, r._first, r.shuffle_key) == (1, 2, 3, 4, 5) for r in mixed.collect())


def test_distribution_is_poisson(spark):
    cdf = spark.range(1).select(mixing.distribution(F.lit(2.5)).alias("c")).first().c
    for k, got in enumerate(cdf[:20]):
        want = sum(math.exp(-2.5) * 2.5**i / math.factorial(i) for i in range(k + 1))
        assert abs(got - want) < 1e-12


# --- chat


@pytest.mark.parametrize("kind", ["end", "turn", "text|>x<|end", "part:end", "", None, "image"])
def test_kinds_of_parts_forge_no_control_string(spark, kind):
    parts = [("text", "before <|part:image|> ", None, None), (kind, None, "a.png", 2), ("text", "after", None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    formatted = chat.format_chat(df)
    row = chat.read_back(formatted).first()
    assert row.n_turns == 1
    text = formatted.first().formatted
    assert text.count("<|end|>") == 1 and text.count("<|turn|>") == 1 and text.count("<|text|>") == 1
    assert [(a.part, a.kind, a.ref) for a in formatted.first().attachments] == [(1, kind, "a.png")]


def test_chat_of_an_empty_table(spark):
    df = spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    assert chat.read_back(chat.format_chat(df)).collect() == []


def test_chat_round_trip_with_control_strings(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|turn|>", "<\\|x|>", "[\\/INST]", "<", "\\", "<<s>", "[[INST]", "$1 é😀", "", None]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, None, None, "no turn"), (None, 0, "assistant", "no id"), (3, 1, "<|end|>", "odd role")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text"))))
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv)
        )
        told = "".join(f"{r}\n{x}\n" for _, r, x in own)
        learnt = "".join(x for _, r, x in own if r == "assistant")
        got = found[conv]
        assert got.n_turns == len(own)
        assert got.turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert got.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert got.loss_chars == len(learnt)


def test_parts_become_placeholders_in_order(spark):
    parts = [
        ("text", "look: ", None, None), ("image", None, "s3://a.png", 4), ("text", " hear <|x|>", None, None),
        ("audio", None, "b.wav", 10), ("document", None, "c.pdf", None), ("video", None, "d", 2),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)],
                               f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    row = chat.format_chat(df).first()
    assert "look: <|part:image|> hear <\\|x|><|part:audio|><|part:document|><|part:video|>" in row.formatted
    assert [(a.turn, a.part, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 1, "image", "s3://a.png", 1024), (0, 3, "audio", "b.wav", 250),
        (0, 4, "document", "c.pdf", 512), (0, 5, "video", "d", 2),
    ]
    assert [(s.turn, s.length) for s in row.loss_spans] == [(1, 0)]
    assert chat.read_back(chat.format_chat(df.where("false"))).count() == 0
