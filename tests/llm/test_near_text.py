from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from callgrain.llm import near_text as n
from callgrain.llm.groups import forest


def shingles(text, size=5):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_force(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    a, b = [i for i, _ in sets], [i for i, _ in sets]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a.append(i), b.append(j)
    root = forest(a, b)
    return {i: (len(s), root[i], root[i] == i) for i, s in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def edited(words, pick, changes):
    words = list(words)
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10_000)}"
    return " ".join(words)


def test_groups_against_brute_force(documents):
    pick = random.Random(5)
    rows = []
    for base in range(30):
        words = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(3, 120))]
        rows += [(len(rows) + k, edited(words, pick, k % 4)) for k in range(pick.randrange(1, 7))]
    pick.shuffle(rows)
    assert found(n.near_groups(documents(rows))) == brute_force(rows)


def test_chains_in_a_shared_band(documents, monkeypatch):
    """Neighbours of a chain are linked, far ones are not; one block or many give the same."""
    words = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(words[6 * k:6 * k + 100])) for k in range(40)]
    expected = brute_force(rows)
    assert found(n.near_groups(documents(rows))) == expected
    monkeypatch.setattr(n, "BLOCK_ITEMS", 300)
    assert found(n.near_groups(documents(rows))) == expected


def test_a_link_that_no_centre_shows(documents, spark):
    """Pairs that are alike among many that share bands but are not: only comparing within bands finds them all."""
    pick = random.Random(8)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for family in range(40):
        own = base[:70] + [f"f{family}_{k}" for k in range(30)]
        rows += [(2 * family, " ".join(own)), (2 * family + 1, edited(own, pick, 2))]
    assert found(n.near_groups(documents(rows))) == brute_force(rows)


def unit(sets, labels, sides, blocks=(0, 0)):
    """Rows of one unit of comparison, as they come to `_joined`."""
    i, j = blocks
    return pa.table({
        "key": pa.array([7] * len(sets), pa.int64()), "i": pa.array([i] * len(sets), pa.int32()), "j": pa.array([j] * len(sets), pa.int32()),
        "side": pa.array(sides, pa.int32()), "label": pa.array(labels, pa.binary()),
        "shingles": pa.array([list(s) for s in sets], pa.list_(pa.int64()))})


def grouped(pairs, labels):
    """Each label's group after `pairs`, by its smallest label."""
    roots = forest(pairs["a"].to_pylist(), pairs["b"].to_pylist())
    return [roots.get(x, x) for x in labels]


def test_units_against_brute_force():
    """A block that meets itself, and two blocks, where only pairs across are compared; as few pairs as join the groups."""
    pick = random.Random(9)
    bases = [pick.sample(range(10_000), pick.randrange(1, 60)) for _ in range(12)]
    sets = [set(b) - set(pick.sample(b, len(b) // 9)) | {pick.randrange(10_000) for _ in range(len(b) // 12)}
            for b in (pick.choice(bases) for _ in range(150))]
    labels = [b"%d" % pick.randrange(90) for _ in sets]
    sides = [pick.randrange(2) for _ in sets]
    for blocks, given in (((2, 2), [1] * len(sets)), ((2, 5), sides)):
        a, b = [], []
        for x in range(len(sets)):
            for y in range(x):
                if (blocks == (2, 2) or sides[x] != sides[y]) and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                    a.append(labels[x]), b.append(labels[y])
        roots = forest(a, b)
        pairs = n._joined(75)(unit(sets, labels, given, blocks))
        assert grouped(pairs, labels) == [roots.get(x, x) for x in labels]
        assert len(pairs) == len(set(labels)) - len({roots.get(x, x) for x in labels})
    alone = n._joined(75)(unit(sets, labels, [0] * len(sets), (2, 5)))
    assert len(alone) == 0 and alone.schema.types == [pa.binary()] * 2


def test_a_large_unit_takes_little_time():
    """1,200 sets of 150 shingles, alike but not linked: 0.2 CPU seconds where a search for each pair took 3.7."""
    pick = np.random.default_rng(10)
    sets = [np.concatenate((np.arange(100), pick.integers(1000, 1 << 62, 50))) for _ in range(1200)]
    rows = unit(sets, [b"%d" % k for k in range(1200)], [1] * 1200)
    began = time.process_time()
    assert len(n._joined(75)(rows)) == 0
    assert time.process_time() - began < 2


def test_strange_rows(strange):
    rows = n.near_groups(strange).collect()
    assert len(rows) == strange.count()
    by = {r.doc_id: r for r in rows}
    assert (by[None].component_id, by[None].kept) == (None, True)
    assert [by[k].n_shingles for k in (1, 2, 3, 6, 7)] == [0, 0, 0, 1, 1]
    assert all(by[k].component_id == k and by[k].kept for k in (1, 2, 3, 4, 6, 7, 8))
    kept = n.first_of_groups(strange)
    assert kept.columns == strange.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 7, 8]


def test_rows_of_one_id_are_judged_by_their_texts(documents):
    words = [f"w{k}" for k in range(60)]
    near = [*words[:59], "other"]
    rows = [(3, " ".join(words)), (5, " ".join(near)), (5, "a clean text of its own with some words"), (5, "another clean text that stands alone"),
            (5, "another clean text that stands alone"), (8, " ".join(near)), (9, "x y z"), (9, "X  y z")]
    for order in (rows, rows[::-1]):
        kept = sorted((r.doc_id, r.text) for r in n.first_of_groups(documents(order, clash=True).repartition(4)).collect())
        assert [k for k in kept if k[0] != 9] == sorted({rows[0], rows[2], rows[3]}) and sum(k[0] == 9 for k in kept) == 1


def test_empty_table(documents):
    assert n.near_groups(documents([])).count() == 0
    assert n.first_of_groups(documents([])).count() == 0


@pytest.mark.parametrize("size", [1, 5, 60, 5000])
def test_signatures_estimate_similarity(size):
    random = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        shared = random.integers(1 << 63, size=3 * size, dtype=np.uint64)
        a, b = np.concatenate((shared, random.integers(1 << 63, size=size, dtype=np.uint64))), shared
        sign = n.signatures(np.concatenate((a, b)), np.repeat([0, 1], [len(a), len(b)]), 2)
        errors.append((sign[0] == sign[1]).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.03


def test_signatures_do_not_depend_on_blocks(monkeypatch):
    items = np.random.default_rng(2).integers(1 << 63, size=900, dtype=np.uint64)
    owner = np.repeat(np.arange(9), 100)
    whole = n.signatures(items, owner, 9)
    monkeypatch.setattr(n, "BLOCK", 37)
    assert (n.signatures(items, owner, 9) == whole).all()
