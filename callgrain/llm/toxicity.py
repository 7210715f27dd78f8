"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(w0 + sum of w_i + sum over pairs <v_i, v_j>), over the terms that a text has. The pair part gives weight to
combinations, such as an insult with a group mention, that a sum of single weights cannot. Terms are words and word
beginnings, hashed into 2**20 places. Places take part by evidence, not up to a number: first all whose presence tells the
classes apart by `least_gain` (log-likelihood ratio in nats), then, after a first fit, all others whose pairs with the
places of that fit would tell more by as much (a term that means something only beside others has no gain alone).

Fitting is bounded: labelled texts in the order of their hashed ids, at most `max_rows` ids and `max_terms` terms of texts in
all (an id that would exceed the sum ends the sample). The driver holds this sample as one list of places, and works on BLOCK
of its entries at a time; of the places that take part it has two lists of entries, by text and by place. Terms come from whole texts. Scoring reads every whole text once, without a shuffle; only the
fitted arrays, of at most 2**20 places, go to the tasks.

Cases: null and empty texts have no terms and get the score of the intercept. Rows with a null label or an id that no
document has do not take part in fitting. Without labels of both classes all scores are equal: 0.75 if there is only label 1,
else 0.25. Repeated rows are scored each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callgrain.llm.words import PUNCTUATION, giving_back, lists, runs, words
from callgrain.sources.sinks import stage

PLACES = 1 << 20
#: Bytes of word beginnings that are terms beside the words.
BEGINNINGS = (4, 6)
#: Entries of the sample that are worked on at a time.
BLOCK = 1 << 17


@dataclass
class Machine:
    """`place[h]` is the row of hashed term h in `weights` and `factors`, or -1."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def constant(positive: int, negative: int) -> Machine:
    """A machine without terms, for examples of one class or none."""
    bias = np.log(3.0) if positive and not negative else -np.log(3.0)
    return Machine(np.full(PLACES, -1, np.int32), float(bias), np.zeros(0, np.float32), np.zeros((0, 1), np.float32))


def text_terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed terms of texts and the text of each; a term may repeat."""
    w = words(column, PUNCTUATION, BEGINNINGS)
    found, text = [w.hash], [w.text]
    for h in w.prefixes.values():
        has = h != 0
        found.append(h[has])
        text.append(w.text[has])
    return (np.concatenate(found) >> np.uint64(44)).astype(np.int64), np.concatenate(text)


@giving_back
def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in runs(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            term, text = text_terms(part.column(1))
            pairs = np.unique(text * PLACES + term)
            counts = np.bincount(pairs // PLACES, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), lists(pairs % PLACES, counts, pa.int32())], names=["label", "rank", "terms"])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = 20_000, max_terms: int = 1 << 22, least_gain: float = 5.0, factors: int = 8, rounds: int = 300,
) -> Machine:
    """Fit on documents whose labels are 0 or 1. An id with several labels counts as 1 if any of them is."""
    chosen = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .withColumn("rank", F.xxhash64("_id")).orderBy("rank", "_id").limit(max_rows)
    )
    # At most max_rows rows of three numbers: broadcast, so that no text is shuffled.
    texts = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "_id").select("label", "text", "rank")
    )
    sets = stage(texts.mapInArrow(_term_sets, "label int, rank long, terms array<int>"), "terms")
    sizes = sets.groupBy("rank").agg(F.sum(F.size("terms")).alias("n")).orderBy("rank").toArrow()
    if not len(sizes):
        return constant(0, 0)
    within = np.flatnonzero(np.cumsum(sizes.column("n").to_numpy()) <= max_terms)
    last = sizes.column("rank")[int(within[-1])].as_py() if len(within) else None
    rows = sets.where(F.col("rank") <= F.lit(last)).orderBy(F.xxhash64("terms"), "label").select("label", "terms").toArrow()
    label = rows.column("label").to_numpy().astype(np.float32)
    positive = int(label.sum())
    if positive in (0, len(label)):
        return constant(positive, len(label) - positive)
    sample = _Sample(rows.column("terms"))
    del rows
    chosen = _gain(sample, label) >= least_gain
    if not chosen.any():
        return constant(positive, len(label) - positive)
    machine = _fitted(sample, label, chosen, factors, rounds)
    more = ~chosen & (_pair_gain(sample, label, machine) >= least_gain)
    return _fitted(sample, label, chosen | more, factors, rounds) if more.any() else machine


class _Sample:
    """The places of all texts on end, and where each text's end."""

    def __init__(self, terms: pa.ChunkedArray):
        self.found = np.concatenate([part.flatten().to_numpy() for part in terms.chunks])
        self.ends = np.cumsum(np.concatenate([part.value_lengths().to_numpy() for part in terms.chunks]), dtype=np.int64)

    def parts(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The text and place of BLOCK entries at a time, in their order."""
        for lo in range(0, len(self.found), BLOCK):
            hi = min(lo + BLOCK, len(self.found))
            first, last = np.searchsorted(self.ends, (lo, hi - 1), side="right")
            size = np.diff(np.minimum(self.ends[first:last + 1], hi), prepend=lo)
            yield np.repeat(np.arange(first, last + 1, dtype=np.int32), size), self.found[lo:hi].astype(np.int64)

    def among(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and `place` of the entries that have one."""
        n, lo = sum(int(np.count_nonzero(place[found] >= 0)) for _, found in self.parts()), 0
        texts, places = np.empty(n, np.int32), np.empty(n, np.int32)
        for text, found in self.parts():
            at = place[found]
            has = at >= 0
            hi = lo + int(np.count_nonzero(has))
            texts[lo:hi], places[lo:hi] = text[has], at[has]
            lo = hi
        return texts, places

    def added(self, *values: np.ndarray) -> list[np.ndarray]:
        """For each place the sum of the texts' values, added in the order of texts."""
        sums = [np.zeros(PLACES) for _ in values]
        for text, found in self.parts():
            for total, value in zip(sums, values):
                np.add.at(total, found, value[text])
        return sums


def _gain(sample: _Sample, label: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each place's presence and the label, rounded, so that order of addition does not show."""
    counts, having = sample.added(np.ones(len(label)), label.astype(np.float64))
    total, ones = float(len(label)), float(label.sum())

    def part(seen, row, column):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(seen > 0, seen * np.log(seen * total / (row * column)), 0.0)

    gain = np.empty(PLACES)
    for lo in range(0, PLACES, BLOCK):
        n, both = counts[lo:lo + BLOCK], having[lo:lo + BLOCK]
        gain[lo:lo + BLOCK] = np.round(
            part(both, n, ones) + part(n - both, n, total - ones) + part(ones - both, total - n, ones)
            + part(total - ones - n + both, total - n, total - ones), 6)
    return gain


def _pair_gain(sample: _Sample, label: np.ndarray, machine: Machine) -> np.ndarray:
    """What a factor for each place would add, to second order, at the factor column where it adds most (in nats)."""
    x = _Groups(*sample.among(machine.place), len(label))
    square = (machine.factors ** 2).sum(axis=1, keepdims=True)
    sums = x.sums(np.concatenate([machine.weights[:, None], machine.factors, square], axis=1)).astype(np.float64)
    inner = sums[:, 1:-1]
    z = machine.bias + sums[:, 0] + 0.5 * ((inner ** 2).sum(axis=1) - sums[:, -1])
    chance = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    best = np.zeros(PLACES)
    for k in range(inner.shape[1]):
        pull, spread = sample.added((label - chance) * inner[:, k], chance * (1 - chance) * inner[:, k] ** 2)
        for lo in range(0, PLACES, BLOCK):
            part = slice(lo, lo + BLOCK)
            best[part] = np.maximum(best[part], pull[part] ** 2 / (2 * (spread[part] + 1.0)))
    return np.round(best, 6, out=best)


def _fitted(sample: _Sample, label, chosen: np.ndarray, factors: int, rounds: int) -> Machine:
    place = np.full(PLACES, -1, np.int32)
    place[chosen] = np.arange(np.count_nonzero(chosen), dtype=np.int32)
    return _descend(_Entries(*sample.among(place), len(label), int(chosen.sum())), label, place, factors, rounds)


class _Entries:
    """Which text has which place, in the order of texts and in that of places."""

    def __init__(self, text: np.ndarray, at: np.ndarray, texts: int, places: int):
        self.by_text = _Groups(text, at, texts)
        turned = (at.astype(np.int64) << 32) | text
        turned.sort()
        self.by_place = _Groups((turned >> 32).astype(np.int32), turned.astype(np.int32), places)


class _Groups:
    """Ascending group numbers with a member each; sums over the members of each group, some whole groups at a time."""

    def __init__(self, group: np.ndarray, member: np.ndarray, groups: int):
        self.member, self.count = member, groups
        self.first = np.flatnonzero(np.concatenate(([len(group) > 0], group[1:] != group[:-1])))
        self.group = group[self.first]
        ends = np.append(self.first[1:], len(group))
        self.cuts = [0]
        while self.cuts[-1] < len(ends):
            lo = self.cuts[-1]
            self.cuts.append(max(lo + 1, int(np.searchsorted(ends, self.first[lo] + BLOCK, side="right"))))

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros((self.count, values.shape[1]), np.float32)
        for lo, hi in zip(self.cuts, self.cuts[1:]):
            begin = self.first[lo]
            end = self.first[hi] if hi < len(self.first) else len(self.member)
            total[self.group[lo:hi]] = np.add.reduceat(values[self.member[begin:end]], self.first[lo:hi] - begin, axis=0)
        return total


def _descend(x: _Entries, label, place, factors: int, rounds: int, decay: float = 2e-3, rate: float = 0.05) -> Machine:
    """Full-batch Adam on the logistic loss with L2 decay. Weights and factors are columns of one table, weights first."""
    random = np.random.default_rng(7)
    share = float(label.mean())
    bias = np.array([np.log(share / (1 - share))], np.float32)
    table = np.concatenate([
        np.zeros((x.by_place.count, 1)), random.normal(0, 0.05, (x.by_place.count, factors))], axis=1).astype(np.float32)
    shrink = np.full(1 + factors, decay, np.float32)
    shrink[0] = decay * 0.1
    state = [bias, table]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    for t in range(1, rounds + 1):
        bias, table = state
        square = (table[:, 1:] ** 2).sum(axis=1, keepdims=True)
        sums = x.by_text.sums(np.concatenate([table, square], axis=1))
        inner = sums[:, 1:-1]
        z = bias + sums[:, 0] + 0.5 * ((inner ** 2).sum(axis=1) - sums[:, -1])
        pull = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / np.float32(len(label))
        slope = x.by_place.sums(np.concatenate([pull[:, None], pull[:, None] * inner], axis=1).astype(np.float32))
        slope[:, 1:] -= table[:, 1:] * slope[:, :1]
        slope += shrink * table
        for k, s in enumerate([np.array([pull.sum()], np.float32), slope]):
            first[k] += np.float32(0.1) * (s - first[k])
            second[k] += np.float32(0.001) * (s * s - second[k])
            step = rate / (1 - 0.9 ** t)
            state[k] = state[k] - np.float32(step) * first[k] / (np.sqrt(second[k] / np.float32(1 - 0.999 ** t)) + np.float32(1e-8))
    return Machine(place, float(state[0][0]), state[1][:, 0].copy(), state[1][:, 1:].copy())


def text_scores(column: pa.Array, machine: Machine) -> np.ndarray:
    """Scores of texts, between 0 and 1."""
    z = np.full(len(column), machine.bias)
    if len(machine.weights):
        for lo, hi in runs(column):
            term, text = text_terms(column.slice(lo, hi - lo))
            at = machine.place[term]
            has = at >= 0
            pairs = np.unique(text[has] * len(machine.weights) + at[has])
            if not len(pairs):
                continue
            text, at = np.divmod(pairs, len(machine.weights))
            first = np.flatnonzero(np.diff(text, prepend=-1))
            factors = machine.factors[at].astype(np.float64)
            inner = np.add.reduceat(factors, first, axis=0)
            square = np.add.reduceat((factors ** 2).sum(axis=1), first)
            single = np.add.reduceat(machine.weights[at].astype(np.float64), first)
            z[lo + text[first]] += single + 0.5 * ((inner ** 2).sum(axis=1) - square)
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and `score`, the higher the likelier label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(text_scores(batch.column(1), shared.value))], names=["id", "score"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    at = docs.columns.index(text_col)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(text_scores(batch.column(at), shared.value) < threshold))

    return docs.mapInArrow(run, docs.schema)
