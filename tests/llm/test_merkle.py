from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from callgrain.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_tree(digests):
    """Root and, for each leaf, its (left, right) siblings level by level, by the definition."""
    paths, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for leaf, i in enumerate(places):
            first = i // 3 * 3
            paths[leaf].append(("".join(digests[first:i]), "".join(digests[i + 1:first + 3])))
        digests = [h("".join(digests[i:i + 3])) for i in range(0, len(digests), 3)]
        places = [i // 3 for i in places]
    return digests[0], paths


def expected(leaves):
    """{(source, id, leaf): (subroot, root, proof)} of (source, id, leaf)."""
    by_source = {}
    for source, i, leaf in sorted(leaves, key=lambda r: (r[0] or "", r[1] is not None, r[1], r[2])):
        by_source.setdefault(source, []).append((i, leaf))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for _, leaf in by_source[s]]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (i, leaf), path in zip(by_source[s], trees[s][1], strict=True):
            out.append((s, i, leaf, trees[s][0], root, h("".join(a + b for a, b in path + top))))
    return out


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_are_a_layout(levels):
    """Every place once; a part of a block lies in one stretch, the top part first."""
    places = [merkle.address(levels, d, np.arange(3 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(places).tolist()) == list(range(merkle.nodes_in(levels)))
    top = levels // 2
    if top:
        assert max(p.max() for p in places[:top]) == merkle.nodes_in(top) - 1
        size = merkle.nodes_in(levels - top)
        for d in range(top, levels):
            part = np.arange(3 ** d) // 3 ** (d - top)
            assert ((places[d] - merkle.nodes_in(top)) // size == part).all()


@pytest.mark.parametrize("height, sizes", [
    (1, [1, 2, 3, 4, 9, 10, 28]), (2, [1, 8, 9, 10, 80, 82, 100]), (6, [1, 2, 3, 4, 728, 729, 730, 1500]),
])
def test_equals_plain_trees(spark, height, sizes):
    rows = [(None if k == 0 else f"s{k}é" if k % 2 else f"S{k}", 1000 * k + i, h(f"{k} {i}")) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, id long, leaf string")
    shown = F.when(F.col("id") % 2 == 0, F.unhex(F.sha2(F.col("leaf").cast("binary"), 256)))
    held = merkle.manifest(df.withColumn("shown", shown), ["shown"], height)
    found = merkle.proofs(held, "shown").collect()
    assert sorted(tuple(r)[:6] for r in found if r["source"]) == sorted(r for r in expected(rows) if r[0])
    assert {tuple(r)[:6] for r in found} == set(expected(rows))
    assert all(r["verified"] == (r["id"] % 2 != 0) and (r["folded_root"] == r["root"]) == r["verified"] for r in found)


def test_strange_rows(strange):
    leaves = strange.select("source", F.col("doc_id").alias("id"), merkle.leaf_hash([F.col(c) for c in merkle.FIELDS]).alias("leaf"))
    given = [tuple(r) for r in leaves.collect()]
    for r in strange.collect():
        values = [r[c] for c in merkle.FIELDS]
        leaf = h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))
        assert (r["source"], r["doc_id"], leaf) in given
    found = merkle.proofs(merkle.manifest(leaves)).collect()
    assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(map(repr, expected(given)))
    assert all(r["verified"] for r in found)


def test_null_and_empty_fields_differ(spark):
    row = spark.range(1).select(
        merkle.leaf_hash([F.lit(None).cast("string"), F.lit(7)]), merkle.leaf_hash([F.lit(""), F.lit(7)]),
        merkle.leaf_hash([F.lit("é"), F.lit(-7)])).first()
    assert tuple(row) == (h("-1:7"), h("0:1:7"), h("2:é2:-7"))


def test_no_rows(documents):
    empty = documents([(1, "x")]).where("false").select("source", F.col("doc_id").alias("id"), F.lit("00").alias("leaf"))
    held = merkle.manifest(empty)
    assert held.root is None and merkle.proofs(held).count() == 0
