from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from callgrain.llm import url_filter as u
from callgrain.llm.queries import RULES, op1_url_filter


def by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def rule_by_hand(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://Www.Example.COM/en/A?x=/es/#y", "https://example.com/en/1",
    "https://a.example.com/en", "http://notexample.com/en/", "http://b.net/es/x", "http://net/fr/", "http://x.net/en/",
    "http://a.com", "http://a.com?q=/", "http://É.COM/é\n/x", "x://y://z/en/", "http://example.com:80/en/", "http://a.com#/x",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(k, url, "h", "r") for k, url in enumerate(URLS)], "page_id long, url string, host string, rule string")
    out = {r.page_id: r for r in u.judged(pages, RULES).collect()}
    assert len(out) == len(URLS)
    for k, url in enumerate(URLS):
        host, path = by_hand(url)
        rule = rule_by_hand(host, path)
        assert (out[k].host, out[k].path) == (host, path)
        assert out[k].rule == (rule.text if rule else None)
        if rule:
            assert out[k].verdict == ("allow" if rule.allow else "block")
        assert out[k].verdict in ("allow", "block")


def local(model):
    return u.Counts.of(model.counts.toArrow())


def urls(n, seed):
    pick = random.Random(seed)
    good = ["news", "river", "school", "garden", "library"]
    bad = ["casino", "jackpot", "betting", "slots", "pills"]
    rows = []
    for k in range(n):
        label = k % 2
        words = good if label else bad
        rows.append((f"https://{pick.choice(words)}-{pick.choice(words)}{pick.randrange(99)}.org/{pick.randrange(9999)}", bool(label)))
    return rows


def test_learns_what_rules_leave_open(spark):
    rows = urls(800, 1)
    model = u.fit(spark.createDataFrame(rows, "url string, accepted boolean"))
    held = urls(200, 2)
    scores = u.text_scores(pa.array([x for x, _ in held]), local(model))
    assert np.mean([(s >= model.threshold) == y for s, (_, y) in zip(scores, held)]) > 0.97
    again = u.fit(spark.createDataFrame(rows[::-1], "url string, accepted boolean").repartition(5))
    assert (local(again).keys == local(model).keys).all() and (local(again).n == local(model).n).all()
    assert again.threshold == model.threshold


def test_scores_against_a_plain_model(spark, monkeypatch):
    """Counts by context in a dictionary, without hashing."""
    rows = urls(300, 3)
    examples = spark.createDataFrame(rows, "url string, accepted boolean")
    model = u.fit(examples)
    from zlib import crc32

    seen = [Counter(), Counter()]
    for url, label in rows:
        raw = url.encode()
        if crc32(raw) % 5:
            for at in range(len(raw)):
                for order in range(u.ORDER + 1):
                    context = (b"\0" * order + raw)[at:at + order]
                    seen[label][order, context] += 1
                    seen[label][order, context, raw[at]] += 1

    def plain(url):
        raw, total = url.encode(), 0.0
        for at in range(len(raw)):
            chance = [1 / 256, 1 / 256]
            for order in range(u.ORDER + 1):
                context = (b"\0" * order + raw)[at:at + order]
                for label in (0, 1):
                    n = seen[label][order, context]
                    chance[label] = (seen[label][order, context, raw[at]] + u.PRIOR * chance[label]) / (n + u.PRIOR)
            total += math.log(chance[1] / chance[0])
        return total / len(raw)

    some = [x for x, _ in urls(60, 4)]
    assert np.allclose(u.text_scores(pa.array(some), local(model)), [plain(x) for x in some], atol=1e-9)
    for size in (u.BLOCK, 100):
        monkeypatch.setattr(u, "BLOCK", size)
        frame = spark.createDataFrame([(x, k, True) for k, x in enumerate(some + ["", None])], "score string, key int, _b boolean")
        out = u.score(frame.withColumnRenamed("score", "url"), model, "url", "key", "_b").collect()
        assert sorted(r.key for r in out) == list(range(62))
        assert all(abs(r.score - (plain(r.url) if r.url else 0)) < 1e-9 for r in out)


def test_without_examples(spark):
    none = u.fit(spark.createDataFrame([], "url string, accepted boolean"))
    assert not none.fitted and none.threshold == 0
    assert [r.score for r in u.score(spark.createDataFrame([(None,), ("",), ("a",)], "url string"), none, "url").collect()] == [0, 0, 0]
    pages = spark.createDataFrame([(1, "http://x.org/"), (1, "http://x.org/"), (None, None)], "page_id long, url string")
    assert [r.verdict for r in u.judged(pages, RULES).collect()] == ["allow"] * 3
    assert u.judged(pages.limit(0), RULES).count() == 0
    one = u.fit(spark.createDataFrame([("http://a", True), (None, False), ("x", None)], "url string, accepted boolean"))
    assert not one.fitted
    long = u.text_scores(pa.array(["http://a.org/" + "x" * 2_000_000, None, ""]), local(u.fit(
        spark.createDataFrame(urls(50, 5), "url string, accepted boolean"))))
    assert np.isfinite(long).all() and long[1:].tolist() == [0, 0]


def test_query_keeps_every_page(spark):
    sf = "/root/testdata/sf0.001"
    assert op1_url_filter(spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()
