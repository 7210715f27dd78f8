from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from callgrain.llm.groups import components, forest
from callgrain.llm.ranks import global_rank


def expected(edges):
    return {x: r for x, r in forest([a for a, _ in edges], [b for _, b in edges]).items() if x != r}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(2, 1), (1, 2), (2, 1)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 300)],
    [(a, b) for a, b in zip(random.Random(3).choices(range(200), k=150), random.Random(4).choices(range(200), k=150))],
])
def test_components(spark, edges):
    links = spark.createDataFrame(edges, "a long, b long").repartition(5)
    found = {r.node: r.root for r in components(links).collect()}
    assert found == expected(edges)


def test_global_rank(spark):
    rows = [(random.Random(k).choice("aaab"), k % 7, k) for k in range(500)]
    df = spark.createDataFrame(rows, "s string, x int, k long").repartition(6)
    ranked = global_rank(df, [F.col("s"), F.col("x"), F.col("k")], "at").collect()
    assert [(r.s, r.x, r.k) for r in sorted(ranked, key=lambda r: r.at)] == sorted(rows)
    assert sorted(r["at"] for r in ranked) == list(range(500))
    assert global_rank(df.limit(0), [F.col("k")], "at").count() == 0
