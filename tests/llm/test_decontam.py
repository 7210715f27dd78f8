from __future__ import annotations

import random
import re

import numpy as np

from callgrain.llm import decontam as d


def plain_alignment(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            best = max(best, new[-1])
        row = new
    return best


def test_alignment_against_the_plain_table():
    pick = random.Random(3)
    items = [np.array([pick.randrange(5) for _ in range(pick.randrange(1, 14))]) for _ in range(60)]
    passages = [np.array([pick.randrange(5) for _ in range(pick.randrange(1, 30))]) for _ in range(60)]
    best, _ = d.align(items, passages)
    assert best.tolist() == [plain_alignment(a.tolist(), b.tolist()) for a, b in zip(items, passages)]


def text(pick, n, vocabulary=4000):
    return [f"w{pick.randrange(vocabulary)}" for _ in range(n)]


def build(pick):
    """Documents that hold an item: whole, edited, in capitals; and clean ones with short shared runs."""
    items = [text(pick, pick.randrange(8, 50)) for _ in range(30)]
    docs, expected = [], set()
    for k in range(200):
        words = text(pick, pick.randrange(0, 300))
        if k % 4 == 0:
            item = pick.randrange(30)
            part = list(items[item])
            if k % 8 == 0:
                for _ in range(len(part) // 8):
                    part[pick.randrange(len(part))] = "changed"
                part.insert(len(part) // 2, "added")
            at = pick.randrange(len(words) + 1)
            words[at:at] = part
            expected.add((k, item))
        elif k % 4 == 1:
            item = pick.randrange(30)
            words[5:5] = items[item][:4]
        docs.append((k, ", ".join(words).upper() if k % 3 else " ".join(words)))
    return docs, [(i, " ".join(x)) for i, x in enumerate(items)], expected


def scores(docs, items):
    """Every document against every item, in full."""
    words = lambda s: re.findall(r"[a-z0-9]+", (s or "").lower())
    return {(i, j): plain_alignment(words(y), words(x)) / (2 * len(words(y))) for i, x in docs for j, y in items if words(y)}


def test_leaks_against_brute_force(spark, documents):
    docs, items, expected = build(random.Random(11))
    found = d.leaks(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    exact = scores(docs, items)
    assert {k for k, s in exact.items() if s >= 0.5} == expected
    assert all(abs(exact[r.doc_id, r.item_id] - r.score) < 1e-9 for r in found)


def test_an_item_copied_into_most_documents(spark, documents):
    pick = random.Random(2)
    item = text(pick, 30)
    docs = [(k, " ".join([*text(pick, 20), *item, *text(pick, 20)] if k % 5 else text(pick, 60))) for k in range(100)]
    found = d.leaks(documents(docs), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {k for k in range(100) if k % 5}


def test_a_popular_edited_copy_beside_a_rarer_exact_one(spark, documents):
    pick = random.Random(6)
    item = text(pick, 40)
    edited = ["changed" if k % 5 == 4 else w for k, w in enumerate(item)]
    docs = [(k, " ".join([*text(pick, 20), *(edited if k else item), *text(pick, 20)])) for k in range(11)]
    docs += [(k, " ".join(text(pick, 60))) for k in range(11, 15)] + [(15, docs[3][1]), (16, " ".join(edited[:4]))]
    rows = [(1, " ".join(item))]
    found = d.leaks(documents(docs), spark.createDataFrame(rows, "item_id long, text string")).collect()
    assert {r.doc_id for r in found} == {*range(11), 15}
    exact = scores(docs, rows)
    assert all(abs(exact[r.doc_id, 1] - r.score) < 1e-9 for r in found)


def test_every_fourth_word_changed(spark, documents):
    pick = random.Random(7)
    items = [text(pick, n) for n in (12, 16, 24, 40)]
    edited = [["changed" if k % 4 == 3 else w for k, w in enumerate(item)] for item in items]
    docs = [(k, " ".join([*text(pick, 30), *edited[k % 4], *text(pick, 30)])) for k in range(40)]
    docs += [(k, " ".join(text(pick, 60))) for k in range(40, 50)]
    found = d.leaks(documents(docs), spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(k, k % 4) for k in range(40)}


def test_recall_over_rates_of_edits(spark, documents):
    """Changed, added and left out words at random places, up to where similarity reaches the threshold."""
    pick = random.Random(8)
    items = [text(pick, pick.randrange(12, 50)) for _ in range(12)]
    docs = []
    for k in range(160):
        rate, part = (k % 8 + 1) / 25, []
        for w in items[k % 12]:
            edit = pick.randrange(3) if pick.random() < rate else None
            part += {None: [w], 0: ["changed"], 1: [w, "added"], 2: []}[edit]
        docs.append((k, " ".join([*text(pick, 20), *part, *text(pick, 20)])))
    rows = [(k, " ".join(x)) for k, x in enumerate(items)]
    exact = {k for k, s in scores(docs, rows).items() if s >= 0.5}
    found = {(r.doc_id, r.item_id) for r in d.leaks(documents(docs), spark.createDataFrame(rows, "item_id long, text string")).collect()}
    assert found <= exact and len(exact) > 100
    print("recall", len(found) / len(exact))
    assert len(found) >= 0.97 * len(exact)


def test_slices_change_nothing(spark, documents, monkeypatch):
    docs, items, expected = build(random.Random(12))
    monkeypatch.setattr(d, "SLICE", 200)
    found = d.leaks(documents(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected


def test_strange_rows(spark, strange):
    items = spark.createDataFrame([
        (1, None), (2, ""), (3, "this one"), (4, "twice the same row of words here"), (4, "other words"), (None, "words without an id"),
    ], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in d.leaks(strange, items).collect()}
    assert found == {(4, 4), (5, 3)}
    kept = d.without_leaks(strange, items)
    assert kept.columns == strange.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 6, 7, 8]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    docs = documents([(1, "a b c d e")])
    assert d.leaks(documents([]), items).count() == 0
    assert d.leaks(docs, items.limit(0)).count() == 0
    assert d.without_leaks(docs, items.limit(0)).count() == 1
    assert d.leaks(docs, items).count() == 1
