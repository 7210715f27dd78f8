from __future__ import annotations

import pytest

#: Columns that operators use inside or add, as columns of the input.
CLASHES = ("id", "n", "node", "score", "size", "place", "ids", "decoded", "token_ids", "label", "_before", "kept", "key")
DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text) or (doc_id, text, source); clash adds columns with the operators' own names."""
    def make(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit("x").alias(c) for c in CLASHES])
        return df

    return make


@pytest.fixture
def strange(documents):
    """Null id, null and empty and blank text, repeated rows, one id with two texts, a very long text, clashing columns."""
    return documents([
        (None, "some words without an id"), (1, None), (2, ""), (3, " \n\t "), (4, "twice the same row of words here"),
        (4, "twice the same row of words here"), (5, "first text of five is this one"), (5, "second text of five differs a lot"),
        (6, "word " * 60_000), (7, "x" * 300_000), (8, "Ünïcode 日本語 \U0001f600 <|endoftext|> </s> \x00\x1c end"),
    ], clash=True)
