"""Line dedup by an exact set-similarity join.

A line is the set of its words. A line goes when an earlier line (by document, then line number)
has the same text or a word set of Jaccard similarity 0.8 or more, whether or not that one stays.

Equal lines are settled first, so only first occurrences are compared. Words are ordered by rarity
over the whole corpus; two similar sets then share a word among the first few (prefix filter), at
places and with lengths that leave room for the overlap (positional and length filters). Pairs are
never written out: a left semi join asks for every prefix word of every line whether a partner
exists, first with a 64-bit sketch of the line (two, if it is long), then, for what is left, with a wide one, and at last
with all words, where the Jaccard similarity is verified. The texts are dealt once by document and
every step that needs them reads that one exchange. Everything is a DataFrame expression.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE, any_of, fresh, settle

RARITY_BITS, LEVELS = 17, (2, 4, 8, 16, 64, 512, 4096)
#: Lines of so many words have a second sketch: 64 bits alone hardly tell them apart.
LONG = 80

_KEYS = ["k1", "k2"]
_LAST = 2**63 - 1


def _keys(df: DataFrame, id_col: str, text_col: str, unique: bool) -> list[Column]:
    """``k1`` and ``k2``: rows equal in both are one document repeated.

    ``k2`` tells texts with the same id apart. Where no id comes twice it is only the sign of
    ``k1``: a literal would drop out of some exchanges, and rows would be dealt again to match.
    """
    text = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    k1 = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST))
    return [k1.alias("k1"), (F.shiftright(k1, 63) if unique else text).alias("k2")]


def has_word(line: Column) -> Column:
    return F.ltrim(line, F.lit(" \t\x0b\x0c\r\n")) != ""


def line_words(line: Column) -> Column:
    """Words of a line, and empty texts among them; plain spaces take the splitter's short way."""
    other = any_of([F.contains(line, F.lit(c)) for c in "\t\x0b\x0c\r"])
    return F.split(F.when(other, F.regexp_replace(line, SPACE, " ")).otherwise(line), " ")


def _bucket(h: Column) -> tuple[Column, Column]:
    """Where the level of a word lies: the cell by the first bits of its hash, and the place in it."""
    return F.shiftrightunsigned(h, 64 - (RARITY_BITS - 4)), h.bitwiseAND(F.lit(60))


def rarity(docs: DataFrame) -> Column:
    """How frequent words of a hash are in all texts: eight levels, four bits each, packed.

    Counts go by ``RARITY_BITS`` bits of the hash; the levels are ranks among these
    counts. A table of 64 kilobytes, whatever the vocabulary. Any order of words gives exact
    results, but the rarer the words that lines meet by, the fewer pairs of lines are compared: words
    that share a bucket with a frequent one count as frequent.
    """
    size = 1 << RARITY_BITS
    words = docs.select(F.explode(F.split("text", " ")).alias("w"))
    cell, place = _bucket(F.xxhash64("w"))
    bucket = F.shiftleft(cell, 4).bitwiseOR(F.shiftright(place, 2)).alias("bucket")
    counts = words.groupBy(bucket).agg(F.count("*").alias("n"))
    found = counts.toArrow()
    n, buckets = found["n"].to_numpy(), found["bucket"].to_numpy()
    rank = np.arange(len(n))
    levels = np.zeros(size, np.uint64)
    levels[buckets[np.lexsort((buckets, -n))]] = sum(rank < size // share for share in LEVELS)
    # As the top bits of a signed number, so the rarest level is the negative one.
    codes = ((levels + np.uint64(4)) % np.uint64(8)).reshape(-1, 16)
    places = np.arange(0, 64, 4, dtype=np.uint64)
    cells = np.bitwise_or.reduce(codes << places, axis=1).view(np.int64)
    packed = ",".join(map(str, cells.tolist()))
    return F.split(F.lit(packed), ",").cast("array<bigint>")


def _ordered(hashes: Column, frequency: Column) -> Column:
    """Words as numbers, rare ones first: three bits of level above, 61 bits of the hash below.

    Every operation here is done once a word, so they are as few as can be.
    """

    def number(h: Column) -> Column:
        cell, place = _bucket(h)
        packed = F.coalesce(F.get(frequency, cell.cast("int")), F.lit(0))
        level = F.call_function("shiftright", packed, place.cast("int"))
        return F.shiftleft(level, 61).bitwiseOR(F.shiftrightunsigned(h, 3))

    return F.sort_array(F.transform(hashes, number))


def _tokens(lines: DataFrame, frequency: Column) -> DataFrame:
    """``line`` replaced by its ordered ``tokens``, each once, and their number ``n``.

    Neither they nor what is made of them may be NULL by type: Spark would push a test for that
    down to the texts, and split and hash every line once more for each such column.

    What stands below a lambda function is interpreted, so the set of hashes is made in a projection
    of its own, where it is compiled; its second use, for ``n``, keeps the two apart. Arrays that
    cannot hold NULL by type are sorted as plain numbers.
    """
    words = line_words(F.coalesce("line", F.lit("")))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    hashes = F.array_except(hashes, F.array(F.xxhash64(F.lit(""))))
    lines = lines.withColumn("hashes", hashes).drop("line")
    tokens = _ordered(F.col("hashes"), frequency)
    return lines.withColumns({"tokens": tokens, "n": F.size("hashes")}).drop("hashes")


def _sketch(tokens: Column, shift: int = 0) -> Column:
    """Parity of the number of tokens per bit, by six bits of their hash.

    Two sketches differ in no more bits than their sets differ in tokens.
    """

    def bit(t: Column) -> Column:
        place = (F.shiftright(t, shift) if shift else t).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.aggregate(tokens, zero, lambda a, t: a.bitwiseXOR(bit(t))), zero)


def _second_sketch(tokens: Column, n: Column) -> Column:
    """For long lines the sketch of about half of the tokens; the first sketch is the parity of this
    half and the other. Zero for short lines."""
    half = F.filter(tokens, lambda t: t.bitwiseAND(F.lit(64)) == 64)
    return F.when(n >= LONG, _sketch(half)).otherwise(F.lit(0).cast("bigint"))


def _wide_sketches(tokens: Column) -> list[Column]:
    """Four sketches of a quarter of the tokens each, for a closer bound on long lines."""

    def quarter(k: int) -> Column:
        own = F.filter(tokens, lambda t: t.bitwiseAND(F.lit(192)) == 64 * k)
        return _sketch(own, 8)

    return [quarter(k) for k in range(4)]


_SAME = "a.k1 = b.k1 AND a.k2 = b.k2 AND a.at = b.at"
_EARLIER = "b.k1 < a.k1 OR (b.k1 = a.k1 AND (b.k2 < a.k2 OR (b.k2 = a.k2 AND b.at < a.at)))"
_FIRST = "a.prev <> b.prev OR a.prev = -1"
# 0.8 asks for an overlap of 4 ninths of both numbers of tokens; no division, as it is the dearest
# part of a test that is done for every pair. What is left after the places bounds the lengths, too.
_PLACES = "9 * (1 + least(a.n - a.place - 1, b.n - b.place - 1)) >= 4 * (a.n + b.n)"


def _apart(columns: list[str]) -> str:
    """Sketches differ in no more than a ninth of all tokens, as similar sets do."""
    bits = " + ".join(f"bit_count(a.{c} ^ b.{c})" for c in columns)
    return f"9 * ({bits}) <= a.n + b.n"


#: Of two long lines each half counts on its own.
_HALVES_APART = (
    f"a.n < {LONG} OR b.n < {LONG} OR 9 * (bit_count(a.sketch ^ a.second ^ b.sketch ^ b.second)"
    " + bit_count(a.second ^ b.second)) <= a.n + b.n"
)


def _having_partner(rows: DataFrame, *conditions: str) -> DataFrame:
    """Rows with a partner of the same token; both sides read one exchange. The conditions are
    tested in order, so what rejects most at the least cost comes first."""
    for name in rows.columns:
        rows = rows.where(F.col(name).isNotNull())
    on = " AND ".join(f"({c})" for c in ("a.token = b.token", *conditions))
    return rows.alias("a").join(rows.alias("b"), F.expr(on), "left_semi")


def _per_document(lines: DataFrame, out: str) -> DataFrame:
    return lines.groupBy(*_KEYS).agg(F.sort_array(F.collect_set("at")).alias(out))


def _hits(rows: DataFrame) -> DataFrame:
    """Per document the lines and tokens of ``rows``."""
    hit = F.struct("at", "token", "place")
    return rows.groupBy(*_KEYS).agg(F.collect_list(hit).alias("hits"))


def _with_texts(docs: DataFrame, picked: DataFrame, numbers: Column) -> DataFrame:
    """``picked`` (a row per document) with a row for each line number in ``numbers``.

    Lines are taken out before rows are made, so that no row carries the whole text.
    """
    rows = docs.join(picked.hint("shuffle_hash"), _KEYS).withColumn("all", F.split("text", "\n"))
    # A second use of the split text keeps Spark from splitting it within the function, per line.
    taken = F.when(F.size("all") > 0, F.transform(numbers, lambda i: F.get("all", i)))
    rows = rows.select(*picked.columns, numbers.alias("ats"), taken.alias("taken"))
    rows = rows.select(*picked.columns, F.explode(F.arrays_zip("ats", "taken")).alias("row"))
    return rows.select(
        *picked.columns, F.col("row.ats").alias("at"), F.col("row.taken").alias("line")
    )


def _again(docs: DataFrame, rows: DataFrame, frequency: Column, **more: Column) -> DataFrame:
    """``rows`` (line and token) once more with ``more`` columns of their lines.

    ``prev`` is the token before in the order of the line: partners that share it too have met
    there already.
    """
    numbers = F.array_distinct(F.transform("hits", lambda h: h["at"]))
    lines = _tokens(_with_texts(docs, _hits(rows), numbers), frequency)
    lines = lines.withColumn("own", F.filter("hits", lambda h: h["at"] == F.col("at")))
    lines = lines.select(*_KEYS, "at", "n", "tokens", "own", *[c.alias(k) for k, c in more.items()])
    lines = lines.withColumn("hit", F.explode("own"))
    prev = F.coalesce(F.get("tokens", F.col("hit.place") - 1), F.lit(-1).cast("bigint"))
    columns = [*_KEYS, "at", "n", "hit.token", "hit.place", prev.alias("prev"), *more]
    return lines.select(*columns)


def kept_lines(docs: DataFrame) -> DataFrame:
    """Per document (``k1``, ``k2``) the lines with a word that are the first of their text, as
    ``firsts``, and those of them that an earlier line is similar to, as ``later``."""
    lines = docs.select(*_KEYS, F.posexplode(F.split("text", "\n")).alias("at", "line"))
    first = lines.where(has_word(F.col("line"))).groupBy(
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")
    )
    first = first.agg(F.min(F.struct(*_KEYS, "at")).alias("first")).select("first.*")
    firsts = settle(_per_document(first, "firsts"), "first-lines")

    frequency = rarity(docs)
    compared = _tokens(_with_texts(docs, firsts, F.col("firsts")), frequency)
    compared = compared.withColumn("sketch", _sketch(F.col("tokens")))
    compared = compared.withColumn("second", _second_sketch(F.col("tokens"), F.col("n")))
    length = F.expr("n - (4 * n + 4) div 5 + 1").cast("int")
    # Half of a word's number is enough to bring lines together; what follows is exact.
    half = F.col("token").bitwiseAND(F.lit(2**31 - 1)).cast("int")
    prefix = F.slice("tokens", F.lit(1), length)
    rows = compared.select(
        *_KEYS, "at", "n", "sketch", "second", F.posexplode(prefix).alias("place", "token")
    ).withColumn("token", half)
    rows = _having_partner(rows, _apart(["sketch"]), _PLACES, f"NOT ({_SAME})", _HALVES_APART)

    wide = {f"s{k}": c for k, c in enumerate(_wide_sketches(F.col("tokens")))}
    rows = _again(docs, rows, frequency, **wide)
    rows = _having_partner(rows, _apart(list(wide)), _PLACES, f"NOT ({_SAME})", _FIRST)

    similar = "9 * size(array_intersect(a.words, b.words)) >= 4 * (a.n + b.n)"
    rows = _again(docs, rows, frequency, words=F.col("tokens"))
    rows = _having_partner(rows, _PLACES, _EARLIER, _FIRST, similar)
    return firsts.join(_per_document(rows, "later"), _KEYS, "left")


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", removed_col: str | None = None
) -> DataFrame:
    """``df`` with the lines of ``text_col`` that stay, joined as before.

    Lines without a word stay. ``removed_col``, if named, counts the lines that went. NULL texts
    stay NULL. NULL ids are later than any other; rows equal in id and text are one document
    repeated and lose the same lines. An empty table stays empty. Words are told apart by 61 bits
    of their hash.
    """
    k1, k2, null, kept, removed = fresh(df, "_k1", "_k2", "_null", "_kept_text", "_removed")
    unique = df.groupBy(id_col).count().where("count > 1").isEmpty()
    keys = _keys(df, id_col, text_col, unique)
    docs = df.select(*keys, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    empty = F.array().cast("array<int>")
    rows = docs.join(kept_lines(docs).hint("shuffle_hash"), _KEYS, "left")
    rows = rows.withColumn("all", F.split("text", "\n"))
    blank = F.transform("all", lambda x, i: F.when(has_word(x), F.lit(-1)).otherwise(i))
    stay = F.concat(
        F.filter(blank, lambda i: i >= 0),
        F.array_except(F.coalesce("firsts", empty), F.coalesce("later", empty)),
    )
    rows = rows.withColumn("stay", F.sort_array(stay))
    rows = rows.select(
        F.col("k1").alias(k1),
        F.col("k2").alias(k2),
        F.array_join(F.transform("stay", lambda i: F.get(F.col("all"), i)), "\n").alias(kept),
        (F.size("all") - F.size("stay")).cast("long").alias(removed),
    )
    if not unique and not docs.groupBy(*_KEYS).count().where("count > 1").isEmpty():
        rows = rows.distinct()
    others = df.select(
        *[c for c in df.columns if c.lower() != text_col.lower()],
        keys[0].alias(k1),
        keys[1].alias(k2),
        F.col(text_col).isNull().alias(null),
    )
    text = F.when(~F.col(null), F.col(kept)).alias(text_col)
    columns = [text if c.lower() == text_col.lower() else F.col(c) for c in df.columns]
    counted = [F.col(removed).alias(removed_col)] if removed_col else []
    return others.join(rows, [k1, k2]).select(*columns, *counted)
