from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Builds a documents table from texts; ids count up unless given as (id, text)."""

    def build(texts, sources=None):
        rows = []
        for i, text in enumerate(texts):
            doc_id, text = text if isinstance(text, tuple) else (i, text)
            source = sources[i] if sources else f"src{i % 3}"
            rows.append((doc_id, text, "en", source, None if text is None else len(text)))
        return spark.createDataFrame(rows, DOCUMENT)

    return build


ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "The same text twice.\nWith two lines.",
    "The same text twice.\nWith two lines.",
    "Ünïcödé wörds, 中文字符 and an emoji 😀 here; tabs\tand\x0bothers\r\n  doubled  spaces. ",
    "<|endoftext|> is ordinary text, so is </s>.",
    "word " * 3000,
    "".join(chr(33 + i % 90) for i in range(5000)),
]


@pytest.fixture
def odd_texts():
    return list(ODD_TEXTS)
