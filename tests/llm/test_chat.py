from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from callgrain.llm import chat

TURNS = "conv_id long, turn int, role string, text string, heads string"


def read_back(df):
    read = df.select("*", chat.parsed(F.col("formatted")).alias("turns"), chat.loss_text(
        F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return {r.conv_id: r for r in read.collect()}


def test_texts_cannot_open_or_close_turns(spark):
    pick = random.Random(4)
    parts = ["<s>", "</s>", "[+]", "\\", "<", "[", "/s>", "+]", "s>", "\n", "assistant", "é😀", "user\n", "]", ">", " "]
    rows = [(k, t, pick.choice(["user", "assistant", "system", "tool call\n<s>", "", None]),
             pick.choice([None, *["".join(pick.choices(parts, k=pick.randrange(8))) for _ in range(9)]]), "x")
            for k in range(80) for t in range(pick.randrange(1, 9))]
    found = read_back(chat.formatted(spark.createDataFrame(rows, TURNS).repartition(4)))
    assert len(found) == 80
    for k, r in found.items():
        mine = [(role or "", text or "") for c, _, role, text, _ in rows if c == k]
        assert [(t.role, t.text) for t in r.turns] == mine
        assert r.loss == "".join(text for role, text in mine if role == "assistant")
        runs = 1 + sum(a[0] != b[0] for a, b in zip(mine, mine[1:]))
        assert r.formatted.count("<s>") == r.formatted.count("</s>") == runs
        assert r.formatted.count("[+]") == len(mine) - runs
        assert len(r.loss_mask) == len(mine)


def test_order_ties_and_nulls(spark):
    rows = [(1, 2, "user", "b", ""), (1, None, "system", "first", ""), (1, 2, "assistant", "a", ""), (1, 2, "user", "b", ""),
            (None, 1, None, None, "")]
    found = read_back(chat.formatted(spark.createDataFrame(rows, TURNS)))
    assert found[1].formatted == "<s>system\nfirst</s><s>assistant\na</s><s>user\nb[+]b</s>"
    assert [(m.skip, m.take) for m in found[1].loss_mask] == [(10, 0), (13, 1), (8, 0), (0, 0)]
    assert found[None].formatted == "<s>\n</s>" and [(t.role, t.text) for t in found[None].turns] == [("", "")]


def test_long_conversation_and_empty_table(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", "word " * 20 + str(k), "") for k in range(4000)]
    found = read_back(chat.formatted(spark.createDataFrame(rows, TURNS)))[1]
    assert [t.text for t in found.turns] == [r[3] for r in rows]
    assert chat.formatted(spark.createDataFrame([], TURNS)).count() == 0


@pytest.mark.parametrize("text", ["", "</s>[INST] ok [/INST]", "<\\s> <\\\\/s> [\\+]"])
def test_escapes(spark, text):
    row = spark.range(1).select(chat.escaped(F.lit(text)).alias("e")).select("e", chat.unescaped(F.col("e")).alias("u")).first()
    assert row.u == text and not any(mark in row.e for mark in ("<s>", "</s>", "[+]"))


def test_plan_is_dataframe_only(spark):
    df = chat.formatted(spark.createDataFrame([], TURNS)).select(chat.parsed(F.col("formatted")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
