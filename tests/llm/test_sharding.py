from __future__ import annotations

import zlib
from collections import Counter

from callgrain.llm import sharding


def test_every_shard_has_the_mixture(documents):
    source = lambda k: "hot" if k % 3 == 0 else f"s{k % 5}" if k % 7 else None
    rows = [(k, "é" * (k % 9), source(k)) for k in range(2003)]
    out = sharding.shards(documents(rows, clash=True), 24).collect()
    assert sorted(r.doc_id for r in out) == list(range(2003))
    for shard in range(24):
        mine = [r for r in out if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert len(mine) in (2003 // 24, 2003 // 24 + 1)
        whole, here = Counter(s for _, _, s in rows), Counter(r.source for r in mine)
        assert all(abs(here[s] - n / 24) <= 2.5 for s, n in whole.items())
    assert all((r.size, r.text_crc32) == (8 + 2 * (r.doc_id % 9), zlib.crc32(("é" * (r.doc_id % 9)).encode())) for r in out)
    again = sharding.shards(documents(rows[::-1]).repartition(7), 24).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in out}
    other = sharding.shards(documents(rows), 24, seed=1).collect()
    assert {(r.doc_id, r.shard) for r in other} != {(r.doc_id, r.shard) for r in out}


def test_strange_rows(strange, documents):
    out = sharding.shards(strange, 24).collect()
    assert len(out) == strange.count() and {r.slot for r in out} == {0}
    assert [(r.size, r.text_crc32) for r in out if r.doc_id in (1, 2)] == [(8, 0), (8, 0)]
    assert sharding.shards(documents([]), 24).count() == 0
    assert [(r.shard, r.slot) for r in sharding.shards(documents([(1, "a")]), 24).collect()] == [(0, 0)]


def test_plan_is_dataframe_only(documents):
    plan = sharding.shards(documents([(1, "a")]), 3)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
