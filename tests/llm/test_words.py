from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from callgrain.llm import words as w

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="abAB é\n\t日.", max_size=40)), max_size=8)


def split(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", low)


@settings(deadline=None, max_examples=150)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = w.words(pa.array(texts, pa.string()))
    expected = [split(t) for t in texts]
    assert list(np.diff(found.first)) == [len(e) for e in expected]
    flat = [x for e in expected for x in e]
    assert (len(set(zip(flat, found.hash.tolist()))) == len(set(flat)) == len(set(found.hash.tolist())))


@settings(deadline=None, max_examples=80)
@given(TEXTS, st.integers(1, 3))
def test_chunks_change_nothing(texts, chunk):
    column = pa.array(texts, pa.string())
    whole = w.words(column, prefixes=(2,))
    old, w.CHUNK = w.CHUNK, chunk
    try:
        cut = w.words(column, prefixes=(2,))
    finally:
        w.CHUNK = old
    assert (whole.hash == cut.hash).all() and (whole.first == cut.first).all()
    assert (whole.prefixes[2] == cut.prefixes[2]).all()


@settings(deadline=None, max_examples=80)
@given(TEXTS)
def test_grams(texts):
    found = w.words(pa.array(texts, pa.string()))
    hashes, at = w.grams(found, 3, short=True)
    expected = []
    for text in texts:
        x = split(text)
        expected += [tuple(x[k:k + 3]) for k in range(len(x) - 2)] if len(x) >= 3 else [tuple(x)] if x else []
    assert len(hashes) == len(expected)
    assert len(set(hashes.tolist())) == len(set(expected))


def test_slices_and_nulls():
    column = pa.array(["a b", None, "c", "a b"])
    part = w.words(column.slice(1, 3))
    whole = w.words(column)
    assert list(np.diff(part.first)) == [0, 1, 2] and (part.hash == whole.hash[2:]).all()
    assert len(w.words(column.slice(0, 0)).hash) == 0


def test_runs_cover_rows_once():
    column = pa.array(["x" * 10, None, "", "y" * 100, "z"])
    assert [k for lo, hi in w.runs(column, 12) for k in range(lo, hi)] == list(range(5))
