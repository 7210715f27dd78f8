from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from callgrain.llm import toxicity as t

FILL = "the of and river stone house tree light water under over green blue paper table chair window road".split()


def corpus(n, seed=1):
    """Toxic: an insult with a group. Neither of them alone is."""
    pick, rows, labels = random.Random(seed), [], []
    for k in range(n):
        kind = k % 4
        words = [pick.choice(FILL) for _ in range(30)]
        if kind in (1, 3):
            words[pick.randrange(30)] = pick.choice(["oafs", "swine"])
        if kind in (2, 3):
            words[pick.randrange(30)] = pick.choice(["plumbers", "bakers"])
        insult = any(w in ("oafs", "swine") for w in words)
        group = any(w in ("plumbers", "bakers") for w in words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(insult and group)))
    return rows, labels


def test_learns_an_interaction_on_held_out_rows(spark, documents):
    rows, labels = corpus(1600)
    docs = documents(rows)
    model = t.fit(docs, spark.createDataFrame(labels[:1200], "doc_id long, toxic int"))
    scores = {r.doc_id: r.score for r in t.score(docs, model).collect()}
    right = [(scores[k] >= 0.5) == bool(y) for k, y in labels[1200:]]
    assert np.mean(right) > 0.97
    # The pair counts for more than the sum of its parts: neither part alone is enough.
    fill = " ".join(FILL)
    one = t.text_scores(pa.array([f"{fill} oafs", f"{fill} bakers", f"{fill} oafs bakers", fill]), model)
    assert one[2] > 0.5 > max(one[0], one[1], one[3])


def test_terms_decide_not_other_columns(spark, documents, strange):
    rows, labels = corpus(400)
    model = t.fit(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = t.score(strange, model).collect()
    assert len(found) == strange.count() and all(0 <= r.score <= 1 for r in found)
    blank = [r.score for r in found if r.doc_id in (1, 2, 3)]
    assert len(set(blank)) == 1
    kept = t.without_toxic(strange, model)
    assert kept.columns == strange.columns
    again = t.fit(documents(rows[::-1]).repartition(5), spark.createDataFrame(labels[::-1], "doc_id long, toxic int"))
    assert np.allclose(again.weights, model.weights, atol=1e-4)


def test_without_both_classes(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for labels, score in (([], 0.25), ([(1, 0)], 0.25), ([(1, 1), (3, None)], 0.75)):
        model = t.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [round(r.score, 6) for r in t.score(docs, model).collect()] == [score, score]
    assert t.score(docs.limit(0), model).count() == 0 and t.without_toxic(docs.limit(0), model).count() == 0


def test_rare_words_that_count_in_pairs_only(spark, documents):
    """250 insults and 250 groups: no word tells much alone, and nearly no pair comes twice."""
    pick, rows, labels = random.Random(5), [], []
    for k in range(10_000):
        words = [f"f{pick.randrange(2000)}" for _ in range(30)]
        insult, group = pick.random() < 0.5, pick.random() < 0.5
        if insult:
            words[3] = f"ins{pick.randrange(250)}x"
        if group:
            words[17] = f"grp{pick.randrange(250)}y"
        rows.append((k, " ".join(words)))
        labels.append((k, int(insult and group)))
    docs = documents(rows)
    model = t.fit(docs, spark.createDataFrame(labels[:8000], "doc_id long, toxic int"))
    held_out = dict(labels[8000:])
    found = {r.doc_id: r.score >= 0.5 for r in t.score(docs, model).collect() if r.doc_id in held_out}
    assert np.mean([found[k] for k, y in held_out.items() if y]) >= 0.95
    assert np.mean([found[k] for k, y in held_out.items() if not y]) <= 0.02


def test_scores_against_a_plain_machine():
    random_ = np.random.default_rng(3)
    chosen = np.zeros(t.PLACES, bool)
    texts = ["the oafs and THE bakers", "", None, "under the stone, under the house; plumbers", "é " * 40]
    for text in texts[::3]:
        chosen[t.text_terms(pa.array([text], pa.string()))[0]] = True
    place = np.where(chosen, np.cumsum(chosen) - 1, -1).astype(np.int32)
    size = int(chosen.sum())
    model = t.Machine(place, -0.3, random_.normal(0, 0.4, size).astype(np.float32), random_.normal(0, 0.4, (size, 3)).astype(np.float32))

    def plain(text):
        has = sorted({int(place[h]) for h in t.text_terms(pa.array([text], pa.string()))[0]} - {-1})
        z = model.bias + sum(float(model.weights[i]) for i in has)
        for n, i in enumerate(has):
            for j in has[:n]:
                z += float(np.dot(model.factors[i].astype(float), model.factors[j].astype(float)))
        return 1 / (1 + np.exp(-z))

    assert np.allclose(t.text_scores(pa.array(texts), model), [plain(x) for x in texts], atol=1e-9)


def test_slope_against_differences():
    """The descent starts along the slope of the plain loss."""
    random_ = np.random.default_rng(4)
    text = np.repeat(np.arange(40, dtype=np.int32), 5)
    at = np.concatenate([random_.choice(12, 5, replace=False) for _ in range(40)]).astype(np.int32)
    label = (random_.random(40) < 0.4).astype(np.float32)
    place = np.arange(12, dtype=np.int32)
    before = t._descend(t._Entries(text, at, 40, 12), label, place, 2, 0)
    after = t._descend(t._Entries(text, at, 40, 12), label, place, 2, 1)

    def loss(weights, factors):
        x = np.zeros((40, 12))
        x[text, at] = 1
        z = before.bias + x @ weights + 0.5 * ((x @ factors) ** 2 - x @ factors ** 2).sum(1)
        return np.mean(np.log1p(np.exp(z)) - label * z) + 1e-4 * (weights ** 2).sum() + 1e-3 * (factors ** 2).sum()

    w, v = before.weights.astype(float), before.factors.astype(float)
    for i in range(12):
        for k in range(2):
            step = np.zeros_like(v)
            step[i, k] = 1e-5
            slope = (loss(w, v + step) - loss(w, v - step)) / 2e-5
            if abs(slope) > 1e-6:
                assert np.sign(after.factors[i, k] - v[i, k]) == -np.sign(slope)


def test_a_bounded_sample(spark, documents):
    rows, labels = corpus(400)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    small = t.fit(documents(rows), known, max_terms=2000)
    assert len(small.weights) and not len(t.fit(documents(rows), known, max_terms=3).weights)


def test_the_driver_holds_the_sample_once(spark):
    """Half a million words, over a million terms: 58 MB at most, 77 with copies of the terms as wider numbers."""
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64("doc_id", k), F.lit(700_000)))
    rows = spark.range(3_000).withColumnRenamed("id", "doc_id").withColumn("toxic", (F.col("doc_id") % 5 == 0).cast("int"))
    docs = rows.select("doc_id", F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(160)), word),
                                             F.when(F.col("toxic") == 1, "oafs")).alias("text")).cache()
    docs.count()
    tracemalloc.start()
    model = t.fit(docs, rows, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    docs.unpersist()
    assert len(model.weights) and peak < 66e6
