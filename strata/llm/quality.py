"""Quality rules as a short-circuit cascade.

Every rule is a condition that rejects a document. Its cost and the share it rejects are measured
on a bounded sample, and rules run by rejection per cost: the cheap rule that rejects much goes
first, and what one rule rejects no later rule looks at. The order changes the work, never the
verdict. Everything is a DataFrame expression.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, fresh, settle, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``reject`` turns measures, got by name, into the rejecting condition; ``needs`` are groups."""

    name: str
    needs: tuple[str, ...]
    reject: Callable[[Callable[[str], Column]], Column]


#: What makes a text too short or too repetitive at any threshold a user would choose.
BASE_RULES = (
    Rule("few_words", ("words",), lambda m: m("n_words") < 10),
    Rule(
        "repeated_words",
        ("words", "repeats"),
        lambda m: 100 * m("n_repeat_words") > 20 * m("n_words"),
    ),
)

#: The cascade of production: markup debris, repeated lines, shouting, broken words.
PRODUCTION_RULES = (
    Rule("symbols", ("words", "symbols"), lambda m: 10 * m("n_symbols") > m("n_words")),
    Rule("repeated_lines", ("lines",), lambda m: 2 * m("n_dup_lines") > m("n_lines")),
    Rule("short_words", ("words",), lambda m: m("word_chars") < 2 * m("n_words")),
    Rule("long_words", ("words",), lambda m: m("word_chars") > 15 * m("n_words")),
    Rule("capitals", ("letters",), lambda m: 2 * m("n_upper") > m("n_letters")),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it.

    A column of its own would do as well, until the optimizer writes its expression into every
    place that uses it, also into the loops of higher-order functions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _word_measures(text: Column) -> Column:
    chars = F.length(F.regexp_replace(text, f"{SPACE}+", ""))
    return F.struct(
        F.size(words(text)).cast("long").alias("n_words"), chars.cast("long").alias("word_chars")
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def _symbol_measures(text: Column) -> Column:
    return F.struct(_count(text, SYMBOLS).alias("n_symbols"))


def _letter_measures(text: Column) -> Column:
    return F.struct(
        _count(text, r"\p{Lu}").alias("n_upper"), _count(text, r"\p{L}").alias("n_letters")
    )


def _line_measures(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(lines: Column) -> Column:
        repeated = F.size(lines) - F.size(F.array_distinct(lines))
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"), repeated.cast("long").alias("n_dup_lines")
        )

    return let(lines, of)


def _repeat_measures(text: Column) -> Column:
    """Words inside windows that occur twice or more in the same text.

    A window is known by the 64-bit hash of its words. Only texts with a repeated window sort
    theirs; each window start then covers its words up to the next repeated start.
    """

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def repeated(in_order: Column) -> Callable[[Column, Column], Column]:
        def hit(e: Column, i: Column) -> Column:
            before = F.coalesce(F.get(in_order, i - 1)["h"] == e["h"], F.lit(False))
            return before | F.coalesce(F.get(in_order, i + 1)["h"] == e["h"], F.lit(False))

        return hit

    def covered(starts: Column) -> Column:
        return F.aggregate(
            F.sort_array(starts),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, x: F.struct(
                (a["n"] + F.least(x - a["last"], F.lit(WINDOW))).alias("n"), x.alias("last")
            ),
            lambda a: a["n"],
        )

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        hits = let(
            pairs, lambda s: covered(F.transform(F.filter(s, repeated(s)), lambda e: e["p"]))
        )
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(hits)

    whole = let(
        words(text),
        lambda w: F.when(F.size(w) > WINDOW, let(hashes(w), count)).otherwise(F.lit(0)),
    )
    return F.struct(whole.cast("long").alias("n_repeat_words"))


#: Measures that are computed together, by the name a rule asks for.
GROUPS = {
    "words": (_word_measures, ("n_words", "word_chars")),
    "symbols": (_symbol_measures, ("n_symbols",)),
    "letters": (_letter_measures, ("n_upper", "n_letters")),
    "lines": (_line_measures, ("n_lines", "n_dup_lines")),
    "repeats": (_repeat_measures, ("n_repeat_words",)),
}


def measure(
    df: DataFrame, text_col: str = "text", groups: Sequence[str] = tuple(GROUPS)
) -> DataFrame:
    """``df`` with the measures of every whole text as long columns.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_upper``, ``n_letters``,
    ``n_lines`` (lines with a word), ``n_dup_lines`` (such lines equal to an earlier one) and
    ``n_repeat_words`` (words in five-word windows found twice or more). NULL and empty texts
    measure zero everywhere. Repeated rows are measured each for itself. Columns of ``df`` with
    these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    for group in groups:
        of, names = GROUPS[group]
        (found,) = fresh(df, f"_{group}")
        df = df.withColumn(found, of(text))
        df = df.withColumns({name: F.col(found)[name] for name in names}).drop(found)
    return df


def rejecting(rule: Rule, text: Column, measured: Sequence[str] = ()) -> Column:
    """The rule's condition on a text; groups in ``measured`` are columns already."""
    have = {n for g in measured for n in GROUPS[g][1]}
    needs = [g for g in rule.needs if g not in measured]
    if not needs:
        return rule.reject(F.col)
    parts = F.struct(*[GROUPS[g][0](text).alias(g) for g in needs])
    place = {n: g for g in needs for n in GROUPS[g][1]}
    return let(
        parts, lambda m: rule.reject(lambda n: F.col(n) if n in have else m[place[n]][n])
    )


def order_rules(
    df: DataFrame, text_col: str, rules: Sequence[Rule], sample_rows: int = 500
) -> list[Rule]:
    """``rules`` by rejection per cost on at most ``sample_rows`` rows; ties stay in order."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("text")
    sample = settle(df.select(text).limit(sample_rows), "quality-sample")

    def run(condition: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        row = sample.agg(F.count("*"), F.count_if(condition)).first()
        return time.perf_counter() - began, row[0], row[1]

    run(F.lit(False))
    empty = run(F.lit(False))[0]

    def worth(rule: Rule) -> float:
        seconds, rows, rejected = run(rejecting(rule, F.col("text")))
        return (rejected / max(rows, 1)) / max(seconds - empty, 1e-3)

    return sorted(rules, key=worth, reverse=True)


def verdict(
    df: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = BASE_RULES + PRODUCTION_RULES,
    sample_rows: int = 500,
    measured: Sequence[str] = (),
) -> Column:
    """The name of the rule that rejects a document of ``df``, else NULL.

    A rule sees only texts that no earlier rule rejected: for the others its measures are not
    computed. Which of several rejecting rules is named depends on the measured order; whether
    one rejects does not. ``sample_rows`` bounds the sample that costs and selectivities come
    from; ``measured`` names groups whose measures ``df`` has as columns. NULL and empty texts are
    rejected as too short.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    case = F.lit(None).cast("string")
    for rule in reversed(order_rules(df, text_col, rules, sample_rows)):
        case = F.when(rejecting(rule, text, measured), F.lit(rule.name)).otherwise(case)
    return case


def keep_good(df: DataFrame, text_col: str = "text", sample_rows: int = 500) -> DataFrame:
    """The rows of ``df`` that no rule rejects, unchanged. An empty table stays empty."""
    return df.where(verdict(df, text_col, sample_rows=sample_rows).isNull())
