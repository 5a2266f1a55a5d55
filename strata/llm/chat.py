"""Chat formatting over typed content parts.

A message is a list of parts (``kind``, ``text``, ``ref``, ``units``). A visitor flattens it in
order: text is escaped and kept, every other kind becomes one placeholder, whose attachment and
expanded token count are recorded. Turns are marked by control strings; control strings inside
texts are escaped reversibly. Everything is a DataFrame expression; a conversation is one row of
output, so its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An opener with any number of backslashes and then the rest of a control string: escaping adds
# one backslash after the opener, unescaping takes one away.
_REST = r"\||/?s>|/?INST\]|/?SYS>>"
ESCAPE = rf"([<\[])(?=\\*(?:{_REST}))"
UNESCAPE = rf"([<\[])\\(?=\\*(?:{_REST}))"

START, ROLE_END, END = "<|turn|>", "<|text|>", "<|end|>"

#: Placeholders begin with this, so that no kind of part can spell another control string.
PLACEHOLDER = "<|part:"

#: Tokens that one unit (image tile, second of audio, page) of an attachment expands to.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}

PART = "struct<kind:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), ESCAPE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1")


def text_part(text: Column) -> Column:
    """One text part, as ``parts`` of a message that is only a string."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    )


def _visit(part: Column) -> Column:
    """What a part leaves in the formatted text."""
    return F.when(part["kind"] == "text", escape(part["text"])).otherwise(
        F.concat(F.lit(PLACEHOLDER), escape(F.coalesce(part["kind"], F.lit("unknown"))), F.lit("|>"))
    )


def _expanded(part: Column) -> Column:
    kinds = F.create_map(*[F.lit(x) for pair in UNIT_TOKENS.items() for x in pair])
    return F.coalesce(kinds[F.coalesce(part["kind"], F.lit(""))], F.lit(1)) * F.coalesce(
        part["units"], F.lit(1)
    )


def format_chat(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    parts_col: str = "parts",
    learn_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: ``formatted``, ``loss_spans``, ``attachments``, ``n_turns``.

    ``loss_spans`` are (turn, start, length) in code points of ``formatted``, one per message of
    ``learn_role``. ``attachments`` list (turn, part, kind, ref, tokens) in order. NULL text, role
    and parts count as empty; NULL turns come first, equal turns in order of role and parts;
    repeated rows are repeated turns; NULL conversation ids form one conversation. A part of any
    kind (NULL is "unknown") leaves a placeholder that is no other control string. Texts of any length are
    kept whole. An empty table gives no rows.
    """
    parts = F.coalesce(F.col(parts_col), F.array().cast(f"array<{PART}>"))
    attached = F.filter(
        F.transform(
            parts,
            lambda p, i: F.struct(
                i.alias("part"),
                p["kind"].alias("kind"),
                p["ref"].alias("ref"),
                _expanded(p).cast("long").alias("tokens"),
            ),
        ),
        lambda a: ~a["kind"].eqNullSafe("text"),
    )
    messages = df.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.array_join(F.transform(parts, _visit), "").alias("body"),
            attached.alias("attached"),
        ).alias("m"),
    )
    whole = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    whole = whole.withColumn(
        "segments",
        F.transform(
            "ms",
            lambda m: F.struct(
                F.concat(F.lit(START), escape(m["role"]), F.lit(ROLE_END)).alias("head"),
                m["body"].alias("body"),
                (m["role"] == learn_role).alias("learn"),
            ),
        ),
    )
    lengths = F.transform(
        "segments",
        lambda s: F.struct(
            F.length(s["head"]).alias("head"),
            F.length(s["body"]).alias("body"),
            s["learn"].alias("learn"),
        ),
    )
    whole = whole.withColumn("lengths", lengths)
    spans = F.aggregate(
        "lengths",
        F.struct(
            F.lit(0).cast("long").alias("at"),
            F.lit(0).alias("turn"),
            F.array().cast("array<struct<turn:int,start:bigint,length:int>>").alias("spans"),
        ),
        lambda a, s: F.struct(
            (a["at"] + s["head"] + s["body"] + len(END)).alias("at"),
            (a["turn"] + 1).alias("turn"),
            F.when(
                s["learn"],
                F.array_append(
                    a["spans"],
                    F.struct(
                        a["turn"].alias("turn"),
                        (a["at"] + s["head"]).alias("start"),
                        s["body"].alias("length"),
                    ),
                ),
            )
            .otherwise(a["spans"])
            .alias("spans"),
        ),
        lambda a: a["spans"],
    )
    attachments = F.flatten(
        F.transform(
            "ms",
            lambda m, t: F.transform(
                m["attached"],
                lambda a: F.struct(
                    t.alias("turn"),
                    a["part"].alias("part"),
                    a["kind"].alias("kind"),
                    a["ref"].alias("ref"),
                    a["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return whole.select(
        "conv_id",
        F.size("ms").cast("long").alias("n_turns"),
        F.array_join(
            F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit(END))), ""
        ).alias("formatted"),
        spans.alias("loss_spans"),
        attachments.alias("attachments"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what ``formatted`` and its loss mask say, with all escapes undone.

    Turns are found by their control strings, loss texts by their spans: a span's offset counts
    from its turn's first character, so each turn is cut from a short string.
    """
    turns = F.split(F.col("formatted"), r"<\|end\|>", -1)
    rows = formatted.withColumn("turns", turns)
    rows = rows.withColumn("turns", F.slice("turns", 1, F.size("turns") - 1))
    rows = rows.withColumn(
        "pieces", F.transform("turns", lambda t: F.split(F.substring(t, len(START) + 1, 2**31 - 1), r"<\|text\|>", 2))
    )
    ends = F.aggregate(
        F.transform("turns", F.length),
        F.array(F.lit(0).cast("long")),
        lambda a, n: F.array_append(a, F.element_at(a, -1) + n + len(END)),
    )
    rows = rows.withColumn("starts", ends)
    told = F.array_join(
        F.transform(
            "pieces",
            lambda p: F.concat(unescape(p[0]), F.lit("\n"), unescape(p[1]), F.lit("\n")),
        ),
        "",
    )
    learnt = F.array_join(
        F.transform(
            "loss_spans",
            lambda s: unescape(
                F.substr(
                    F.get(F.col("turns"), s["turn"]),
                    (s["start"] - F.get(F.col("starts"), s["turn"]) + 1).cast("int"),
                    s["length"],
                )
            ),
        ),
        "",
    )
    rows = rows.withColumn("learnt", learnt)
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
