from __future__ import annotations

import numpy as np
import pytest

from callgrain.llm import near_vectors as n
from callgrain.llm.groups import forest

SHAPE = "vec_id long, embedding array<float>, label int, node string, links string"


def table(spark, vectors):
    rows = [(k, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y") for k, v in vectors]
    return spark.createDataFrame(rows, SHAPE).repartition(4)


def brute_force(vectors):
    good = {}
    for k, v in vectors:
        x = np.array([np.nan if c is None else c for c in v or []], np.float32).astype(float)
        if k is not None and len(x) and np.isfinite(x).all() and x.any():
            good[k] = x / np.sqrt(x @ x)
    links = {k: 0 for k, _ in vectors}
    a, b = list(links), list(links)
    ids = list(good)
    for i, p in enumerate(ids):
        for q in ids[:i]:
            if len(good[p]) == len(good[q]) and good[p] @ good[q] >= 0.95:
                links[p] += 1
                links[q] += 1
                a.append(p), b.append(q)
    root = forest(a, b)
    return {k: (links[k], root[k], root[k] == k) for k in links}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def family(random, size, count, noise):
    base = random.standard_normal(size)
    return [base + noise * random.standard_normal(size) for _ in range(count)]


@pytest.mark.parametrize("block, window", [(2048, 32), (64, 4), (16, 16)])
def test_groups_against_brute_force(spark, monkeypatch, block, window):
    random = np.random.default_rng(3)
    vectors = list(random.standard_normal((150, 16)))
    for count in (2, 2, 3, 9, 120):
        vectors += family(random, 16, count, 0.03)
    vectors += [vectors[0]] * 40 + [2 * vectors[1], -vectors[1]]
    vectors = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    monkeypatch.setattr(n, "BLOCK", block)
    assert found(n.near_groups(table(spark, vectors), window=window)) == brute_force(vectors)


def test_recall_at_the_threshold(spark):
    """Pairs of cosine 0.95 to 0.96, the hardest, among others."""
    random, vectors = np.random.default_rng(4), []
    for _ in range(300):
        a, b = random.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        c = random.uniform(0.951, 0.96)
        vectors += [a, c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)]
    vectors = [(k, v.astype(np.float32).tolist()) for k, v in enumerate([*vectors, *random.standard_normal((2000, 32))])]
    expected, got = brute_force(vectors), found(n.near_groups(table(spark, vectors)))
    links = sum(v[0] for v in expected.values())
    assert links >= 600 and sum(v[0] for v in got.values()) >= 0.98 * links
    assert all(got[k][0] <= expected[k][0] for k in got)


@pytest.mark.parametrize("count, passes", [(2_000, 6), (60_000, 11), (1_000_000, 19), (10_000_000, 29), (100_000_000, 41)])
def test_passes_grow_with_the_vectors(count, passes):
    agree = 1 - np.arccos(0.95) / np.pi
    assert n.passes_for(count, 0.95) == passes
    assert 1 - (1 - agree ** n.shared_bits(count)) ** passes >= 0.99


def test_recall_with_the_bits_of_a_large_table(spark, monkeypatch):
    """Shared bits as for 10 million vectors, no window: the pairs at the threshold are found by more passes."""
    random, vectors = np.random.default_rng(8), []
    for _ in range(300):
        a, b = random.standard_normal((2, 32))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        vectors += [a, 0.951 * a + np.sqrt(1 - 0.951 ** 2) * b / np.linalg.norm(b)]
    vectors = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    log2 = n.math.log2
    monkeypatch.setattr(n.math, "log2", lambda x: log2(x * 10_000_000 / 600))
    expected, got = brute_force(vectors), found(n.near_groups(table(spark, vectors), window=0))
    links = sum(v[0] for v in expected.values())
    assert links >= 600 and sum(v[0] for v in got.values()) >= 0.97 * links


def test_strange_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]),
        (9, [1e-30, 0.0]), (10, [3e38, 1e38]), (11, [-0.0, 2.0]), (12, [0.0, 1.0]),
    ]
    df = table(spark, vectors)
    assert found(n.near_groups(df)) == brute_force(vectors)
    twice = n.near_groups(df.union(df)).collect()
    assert len(twice) == 24 and {(r.vec_id, r.n_links) for r in twice if r.vec_id in (7, 8)} == {(7, 3), (8, 1)}
    anonymous = n.near_groups(table(spark, [(None, [1.0, 0.0]), (1, [1.0, 0.0])])).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in anonymous} == {(None, 0, None, True), (1, 0, 1, True)}
    assert n.near_groups(df.limit(0)).count() == 0
