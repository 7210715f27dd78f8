"""Words and word n-grams of Arrow text columns as 64-bit hashes, computed on whole columns with numpy.

A helper of functions that run inside Spark tasks. Work goes in runs of about CHUNK bytes, cut where no word crosses, so
memory follows the words of a batch and not several copies of its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 16
#: Rows of a batch are worked on in runs of about this many bytes.
RUN_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes between words: space, and tab to carriage return.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: The same and all other ASCII bytes that are neither letters nor digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    table = _powers[kind]
    if len(table) < n:
        step = np.full(max(n, CHUNK + 1), _BASE if kind == "up" else _INVERSE, np.uint64)
        step[0] = 1
        table = _powers[kind] = np.multiply.accumulate(step)
    return table[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and where each text begins (one more entry than texts). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    at = np.frombuffer(places, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def runs(column: pa.Array, most: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lo, hi
        lo = hi


Batches = Iterator[pa.RecordBatch]


def giving_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`run`, after which Arrow gives back the memory that it holds without using it.

    Python processes stay for later tasks, and what they hold then is missing to the executor beside them.
    """
    @wraps(run)
    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


@dataclass
class Words:
    """`text[i]` is the text of word i, `first[t]:first[t + 1]` are the words of text t."""

    hash: np.ndarray
    text: np.ndarray
    first: np.ndarray
    #: By length in bytes: hash of each word's beginning, for words of at least that length, else 0.
    prefixes: dict[int, np.ndarray]


def words(column: pa.Array, breaks: np.ndarray = SPACES, prefixes: tuple[int, ...] = ()) -> Words:
    raw, at = text_bytes(column)
    begins = np.zeros(len(raw) + 1, bool)
    begins[at] = True
    found: list[list[np.ndarray]] = []
    lo = 0
    while lo < len(raw):
        hi = min(len(raw), lo + CHUNK)
        if hi < len(raw):
            cuts = np.flatnonzero(breaks[raw[lo + 1:hi + 1]] | begins[lo + 1:hi + 1])
            if len(cuts):
                hi = lo + 1 + int(cuts[-1])
            else:
                # A word longer than a chunk: go on to its end.
                while hi < len(raw) and not (breaks[raw[hi]] or begins[hi]):
                    step = raw[hi:hi + CHUNK]
                    cuts = np.flatnonzero(breaks[step] | begins[hi:hi + len(step)])
                    hi += int(cuts[0]) if len(cuts) else len(step)
        part = raw[lo:hi]
        inside = ~breaks[part]
        fresh = begins[lo:hi]
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:] & ~fresh[1:], [False]))
        start = np.flatnonzero(inside & (~before | fresh))
        end = np.flatnonzero(inside & ~after) + 1
        if len(start):
            weighted = (LOWER[part].astype(np.uint64) + _U(1)) * _power("up", len(part))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)))
            back = _power("down", len(part))[start]
            size = end - start
            hashed = [mix((total[end] - total[start]) * back + size.astype(np.uint64) * _U(0xD6E8FEB86659FD93))]
            for length in prefixes:
                reach = np.minimum(start + length, end)
                h = mix((total[reach] - total[start]) * back + _U(length))
                hashed.append(np.where(size >= length, h, _U(0)))
            found.append([start + lo, *hashed])
        lo = hi
    if found:
        start, *hashed = (np.concatenate(x) for x in zip(*found))
    else:
        start, *hashed = np.zeros(0, np.int64), *(np.zeros(0, np.uint64) for _ in range(1 + len(prefixes)))
    first = np.searchsorted(start, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(hashed[0], text, first, dict(zip(prefixes, hashed[1:])))


def grams(w: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and the first word of each.

    short: a text of fewer words, but at least one, gives its whole sequence as one run.
    """
    def of(first: np.ndarray, size: int) -> np.ndarray:
        h = np.full(len(first), size, np.uint64)
        for k in range(size):
            h = mix(h * _U(0x100000001B3) + w.hash[first + k])
        return h

    at = np.arange(max(0, len(w.hash) - n + 1))
    at = at[w.text[at] == w.text[at + n - 1]] if len(at) else at
    found = of(at, n)
    if short:
        count = np.diff(w.first)
        for size in range(1, n):
            begin = w.first[:-1][count == size]
            if len(begin):
                at, found = np.concatenate((at, begin)), np.concatenate((found, of(begin, size)))
    return found, at


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values on end and the size of each list."""
    places = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values, kind))
