"""Merkle fingerprints of documents, and the likeness of two texts by their trees.

A text is a list of paragraphs (lines), each hashed whole; ``SECTION`` paragraphs make a section.
Each inner node hashes the hashes below it, 128 bits wide, so equal roots mean equal texts; where
roots differ, only branches with differing hashes need a look. Below a paragraph stand short digests
of its pieces of up to ``LEAF`` code points, from which likeness is told and no hash is built.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, partitions

LEAF = 32
SECTION = 8


def leaves(text: Column) -> Column:
    """One array of short leaf digests per paragraph; NULL counts as the empty text."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n"),
        lambda line: F.transform(
            F.regexp_extract_all(line, F.lit(rf"[^\n]{{1,{LEAF}}}"), F.lit(0)),
            lambda leaf: F.substring(F.md5(leaf), 1, 8),
        ),
    )


def paragraphs(text: Column) -> Column:
    """The digest of every whole paragraph; NULL counts as the empty text."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.md5(line))


def render(df: DataFrame, paragraph_col: str, leaf_col: str, out: str) -> DataFrame:
    """Adds the fingerprint of the digests in ``paragraph_col`` and ``leaf_col``.

    ``root;section,...;paragraph,...;leaf leaf,leaf,...``: commas part paragraphs or sections,
    spaces the leaves of one paragraph.
    """
    (s,) = fresh(df, "_sections")
    own = F.col(paragraph_col)
    starts = F.sequence(F.lit(1), F.size(own), F.lit(SECTION))
    sections = F.transform(starts, lambda i: F.md5(F.array_join(F.slice(own, i, SECTION), ",")))
    lines = F.transform(leaf_col, lambda x: F.array_join(x, " "))
    df = df.withColumn(s, F.array_join(sections, ","))
    fingerprint = F.concat_ws(
        ";",
        F.sha2(F.col(s), 256),
        F.col(s),
        F.array_join(own, ","),
        F.array_join(lines, ","),
    )
    return df.withColumn(out, fingerprint).drop(s)


def likeness(a: Column, b: Column) -> Column:
    """Share of the larger tree's distinct leaves that the other has too; 1 for two empty trees."""
    larger = F.greatest(F.size(a), F.size(b))
    return F.when(larger == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)).cast("double") / larger
    )


def parse(fingerprint: Column) -> Column:
    """The leaf digests of a fingerprint, one array per paragraph."""
    return F.transform(
        F.split(F.split(fingerprint, ";")[3], ",", -1),
        lambda line: F.filter(F.split(line, " "), lambda x: x != ""),
    )


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the Merkle fingerprint of each whole text.

    NULL and empty texts have the tree of one empty paragraph; equal texts have equal
    fingerprints, so repeated rows have too. An empty table stays empty.
    """
    paragraph, leaf = fresh(df, "_paragraphs", "_leaves")
    text = F.col(text_col)
    rows = df.withColumns({paragraph: paragraphs(text), leaf: leaves(text)})
    return render(rows, paragraph, leaf, out).drop(paragraph, leaf)


def differing(old: Column, new: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``new`` whose branch ``old`` lacks at that place.

    Equal roots give none; equal sections are skipped as a whole.
    """

    def level(fingerprint: Column, k: int) -> Column:
        return F.split(F.split(fingerprint, ";")[k], ",", -1)

    changed_sections = F.filter(
        F.transform(
            level(new, 1),
            lambda x, i: F.when(x.eqNullSafe(F.get(level(old, 1), i)), F.lit(-1)).otherwise(i),
        ),
        lambda i: i >= 0,
    )
    changed = F.flatten(
        F.transform(
            changed_sections,
            lambda s: F.filter(
                F.transform(
                    F.slice(level(new, 2), s * SECTION + 1, SECTION),
                    lambda x, j: F.when(
                        x.eqNullSafe(F.get(level(old, 2), s * SECTION + j)), F.lit(-1)
                    ).otherwise(s * SECTION + j),
                ),
                lambda i: i >= 0,
            ),
        )
    )
    same = F.split(old, ";")[0] == F.split(new, ";")[0]
    return F.when(same, F.array().cast("array<int>")).otherwise(changed)


def with_next(
    df: DataFrame, id_col: str, value_col: str, out: str, rows_per_range: int = 1000
) -> DataFrame:
    """Adds the value of the next row by descending id; the last row gets that of the first.

    Ids are cut into ranges of about equally many rows; each range is one window partition, and
    the first row of the next range closes it. Only one number per range meets the driver. NULL
    ids come last; rows with the same id follow each other in the order of their values. An empty
    table stays empty, a single row is its own next.
    """
    part, closing = fresh(df, "_range", "_closing")
    ranges = max(1, min(df.count() // rows_per_range + 1, 8 * partitions(df.sparkSession)))
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(F.percentile_approx(id_col, shares, 100 * ranges)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    above = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    number = F.size(F.filter(above, lambda c: c >= F.col(id_col)))
    numbered = df.withColumn(
        part, F.when(F.col(id_col).isNull(), len(cuts) + 1).otherwise(number)
    )
    heads = sorted(numbered.groupBy(part).agg(F.max(id_col)).collect())
    before = {row[0]: heads[i - 1][0] for i, row in enumerate(heads)}
    is_head = F.col(id_col).isin([row[1] for row in heads if row[1] is not None])
    if any(row[1] is None for row in heads):
        is_head = is_head | F.col(id_col).isNull()
    first = numbered.where(is_head).groupBy(part).agg(F.min(value_col).alias(value_col))
    moved = F.lit(None).cast("int")
    if heads:
        moved = F.element_at(
            F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), F.col(part)
        )
    closers = first.select(
        moved.cast("int").alias(part), F.col(value_col), F.lit(True).alias(closing)
    )
    order = Window.partitionBy(part).orderBy(
        F.col(closing), F.col(id_col).desc_nulls_last(), F.col(value_col)
    )
    rows = numbered.withColumn(part, F.col(part).cast("int")).withColumn(closing, F.lit(False))
    joined = rows.unionByName(closers, allowMissingColumns=True)
    joined = joined.withColumn(out, F.lead(value_col).over(order))
    return joined.where(~F.col(closing)).drop(part, closing)


def edited_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each document and of its text with the second half taken from the next.

    The last floor(n/2) code points give way to the first as many (or all) of the next document
    by descending id. Returns id, ``n_chars``, ``edited_sha256``, both fingerprints, the likeness
    to the edited text (``near_edited``) and to the next document (``near_next``).
    """
    base = df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    rows = with_next(base, "doc_id", "text", "next_text")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - half).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(F.substring("text", F.lit(1), kept), F.substring("next_text", F.lit(1), half)),
    )
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("paragraphs"),
        paragraphs(F.col("edited")).alias("edited_paragraphs"),
        leaves(F.col("text")).alias("leaves"),
        leaves(F.col("edited")).alias("edited_leaves"),
        F.array_distinct(F.flatten(leaves(F.col("next_text")))).alias("next_set"),
    )
    rows = rows.withColumns(
        {
            "own_set": F.array_distinct(F.flatten("leaves")),
            "edited_set": F.array_distinct(F.flatten("edited_leaves")),
        }
    ).withColumns(
        {
            "near_edited": likeness(F.col("own_set"), F.col("edited_set")),
            "near_next": likeness(F.col("own_set"), F.col("next_set")),
        }
    ).drop("own_set", "edited_set", "next_set")
    rows = render(rows, "paragraphs", "leaves", "fingerprint")
    rows = render(rows, "edited_paragraphs", "edited_leaves", "edited_fingerprint")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
