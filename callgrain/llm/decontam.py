"""Benchmark decontamination: n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

1. One pass over the texts looks up every run of four words, and of three, among those of the test items. It keeps, where a run of four
   occurs, or FEW runs of three no further apart than the longest item, the surrounding words (as hashes, as far as the longest
   item reaches on either side). Overlapping surroundings are one passage. Nothing else of a text is kept or shuffled.
2. Passages of equal words are one, however many documents hold them. Every passage is paired with every item it shares a run of four
   with, or FEW runs of three (items from LONG words on: copies of which every fourth word is changed have no run of four), however frequent that run is: a frequency counts the contaminated documents too, so it would switch off the runs of
   what was copied most.
3. Pairs are aligned word by word: 2 for an equal word, -1 for a changed, added or left out one. The similarity is the best
   local score over twice the item's words. From 0.5 on the document counts as contaminated; two random texts of the same
   language stay below 0.3. Pairs where the passage has too few of the item's words to reach the least score are not aligned.

A run of F distinct passages and G items gives F x G pairs, so phrases that many items share cost most. An edited copy of a short item
without four unedited words on end, or of a long one without these and with fewer than FEW runs of three, is not found.

The hashes of the items' runs go to the tasks in slices of items with about SLICE runs, one pass over the texts for each slice (a slice
holds some 50,000 items). A slice is of limited size, but all are broadcast in one job, so their sum grows with the benchmark. The
surroundings of all passages reach as far as the longest item.

Words are lower-cased, split at ASCII bytes that are neither letters nor digits. Items of fewer than four words
are one run. Cases: null and empty texts and items match nothing; rows without id are not reported; an id or item given more
than once is one document or item with several texts, of which the best score counts. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callgrain.llm.words import PUNCTUATION, Words, giving_back, grams, lists, mix, runs, words
from callgrain.sources.sinks import stage

RUN = 4
#: Runs of three words: how many of them stand for one run of four, in items of how many words.
SHORT, FEW, LONG = 3, 3, 12
SLICE = 1 << 22
EQUAL, CHANGED = 2, -1
#: Cells of the alignment tables held at a time.
CELLS = 1 << 19


def _lowered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("text"))


def _runs_of(items: DataFrame) -> DataFrame:
    """(item, words, runs, triples) of each test item that has words; triples of long items only."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = words(batch.column(1), PUNCTUATION)
            found, at = grams(w, RUN, short=True)
            order = np.argsort(w.text[at], kind="stable")
            three, begin = grams(w, SHORT)
            three, of = three[np.diff(w.first)[w.text[begin]] >= LONG], w.text[begin][np.diff(w.first)[w.text[begin]] >= LONG]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), lists(w.hash.view(np.int64), np.diff(w.first), pa.int64()),
                lists(found[order].view(np.int64), np.bincount(w.text[at], minlength=len(batch)), pa.int64()),
                lists(three.view(np.int64), np.bincount(of, minlength=len(batch)), pa.int64()),
            ], names=["item", "words", "runs", "triples"])

    kind = items.schema["id"].dataType.simpleString()
    return items.mapInArrow(run, f"item {kind}, words array<long>, runs array<long>, triples array<long>").where("size(words) > 0")


def _short_runs(w: Words, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of RUN words, and of the lengths that short items have."""
    found = [grams(w, n) for n in (RUN, *lengths)]
    return np.concatenate([f for f, _ in found]), np.concatenate([at for _, at in found])


class _Known:
    """A sorted list of hashes, with a table of their first bits that most others miss."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def among(self, found: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those that are known, by place."""
        maybe = self.seen[(found >> np.uint64(44)).astype(np.int64)]
        found, at = found[maybe], at[maybe]
        if not len(found):
            return found, at
        place = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        found, at = found[self.hashes[place] == found], at[self.hashes[place] == found]
        order = np.argsort(at, kind="stable")
        return found[order], at[order]


def _close(at: np.ndarray, text: np.ndarray, within: int) -> np.ndarray:
    """Which places have FEW of their text, themselves included, in some stretch of `within` words."""
    close = np.zeros(len(at), bool)
    last = FEW - 1
    if len(at) > last:
        first = np.flatnonzero((at[last:] - at[:-last] <= within) & (text[last:] == text[:-last]))
        for k in range(FEW):
            close[first + k] = True
    return close


def _passages(texts: DataFrame, known: tuple[np.ndarray, np.ndarray], lengths: list[int], longest: int) -> DataFrame:
    """(id, at, words, runs, triples): passages around known runs, by place of their first word."""
    shared = texts.sparkSession.sparkContext.broadcast(known)
    reach = 2 * longest  # room for what an edited copy adds

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, three = (_Known(k) for k in shared.value)
        for batch in batches:
            for lo, hi in runs(batch.column(1)):
                w = words(batch.column(1).slice(lo, hi - lo), PUNCTUATION)
                found, at = whole.among(*_short_runs(w, lengths))
                less, places = three.among(*grams(w, SHORT))
                close = _close(places, w.text[places], reach)
                less, places = less[close], places[close]
                around = np.union1d(at, places)
                if not len(around):
                    continue
                text = w.text[around]
                begin = np.maximum(around - reach, w.first[text])
                end = np.minimum(around + reach, w.first[text + 1])
                fresh = np.ones(len(around), bool)
                fresh[1:] = (text[1:] != text[:-1]) | (begin[1:] > end[:-1])
                head = np.flatnonzero(fresh)
                tail = np.append(head[1:], len(around)) - 1
                start = around[head]
                begin, end = begin[head], end[tail]
                inside = np.repeat(begin - np.concatenate(([0], np.cumsum(end - begin)[:-1])), end - begin)
                inside = inside + np.arange(len(inside))

                def of(hashes: np.ndarray, where: np.ndarray) -> pa.Array:
                    passage = np.searchsorted(start, where, side="right") - 1
                    return lists(hashes.view(np.int64), np.bincount(passage, minlength=len(start)), pa.int64())

                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(text[head] + lo)), pa.array(begin - w.first[text[head]], pa.int64()),
                    lists(w.hash[inside].view(np.int64), end - begin, pa.int64()), of(found, at), of(less, places),
                ], names=["id", "at", "words", "runs", "triples"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, at long, words array<long>, runs array<long>, triples array<long>")


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman on words: best local score of each pair, and the word of the passage where it ends.

    Pairs are filled up to one size and done side by side. A row's gaps along the passage are a running maximum.
    """
    n, long, wide = len(items), max(map(len, items)), max(map(len, passages))
    a, b = np.zeros((n, long), np.int64), np.zeros((n, wide), np.int64)
    is_a, is_b = np.zeros((n, long), bool), np.zeros((n, wide), bool)
    for k, (x, y) in enumerate(zip(items, passages)):
        a[k, :len(x)], b[k, :len(y)] = x, y
        is_a[k, :len(x)], is_b[k, :len(y)] = True, True
    slope = -CHANGED * np.arange(1, wide + 1, dtype=np.int32)
    row = np.zeros((n, wide + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for i in range(long):
        step = np.where((b == a[:, i:i + 1]) & is_b, EQUAL, CHANGED).astype(np.int32)
        cell = np.maximum(np.maximum(row[:, :-1] + step, row[:, 1:] + CHANGED), 0)
        cell = np.maximum.accumulate(cell + slope, axis=1) - slope
        cell[~is_a[:, i]] = 0
        row[:, 1:] = cell
        at = cell.argmax(axis=1)
        high = cell[np.arange(n), at]
        end = np.where(high > best, at, end)
        best = np.maximum(best, high)
    return best, end


def _shared_words(items: pa.ListArray, passages: pa.ListArray) -> np.ndarray:
    """How many of each item's words its passage has, at any place."""
    def keys(lists_of: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        pair = np.repeat(np.arange(len(lists_of)), np.array(lists_of.value_lengths()))
        return mix(lists_of.flatten().to_numpy().view(np.uint64) ^ mix(pair.astype(np.uint64))), pair

    mine, pair = keys(items)
    theirs, _ = keys(passages)
    return np.bincount(pair[np.isin(mine, theirs)], minlength=len(items))


def _aligned(pairs: DataFrame, least: float) -> DataFrame:
    """(passage, item, score, end) of pairs (passage, item, words, item_words) that reach `least`, a share of the highest score."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            mine, theirs = whole.column("item_words"), whole.column("words")
            # Only equal words add to a score.
            able = _shared_words(mine, theirs) >= least * np.array(mine.value_lengths())
            batch = whole.filter(pa.array(able))
            mine, theirs = batch.column("item_words"), batch.column("words")
            cells = np.array(mine.value_lengths()).astype(np.int64) + np.array(theirs.value_lengths())
            order = np.argsort(cells, kind="stable")
            score, end, lo = np.zeros(len(batch)), np.zeros(len(batch), np.int64), 0
            while lo < len(order):
                hi = lo + 1
                while hi < len(order) and (hi + 1 - lo) * cells[order[hi]] <= CELLS:
                    hi += 1
                some = order[lo:hi]
                one = [mine[int(k)].values.to_numpy() for k in some]
                best, place = align(one, [theirs[int(k)].values.to_numpy() for k in some])
                score[some], end[some] = best / (EQUAL * np.array([len(x) for x in one])), place
                lo = hi
            yield pa.RecordBatch.from_arrays([
                batch.column("passage"), batch.column("item"), pa.array(score), pa.array(end)],
                names=["passage", "item", "score", "end"]).filter(pa.array(score >= least))

    kind = pairs.schema["item"].dataType.simpleString()
    return pairs.mapInArrow(run, f"passage binary, item {kind}, score double, end long")


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", least: float = 0.5,
) -> DataFrame:
    """(id, item, score, end_word): documents and the test items that they hold, with similarity from `least` on."""
    texts = _lowered(docs, id_col, text_col)
    items = stage(_runs_of(_lowered(benchmark, item_col, item_text_col)), "items")
    reach = items.agg(F.max(F.size("words"))).first()[0]
    if reach is None:
        found = texts.select("id").crossJoin(items.select("item").limit(0)).select(
            "id", "item", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("end"))
    else:
        passages = stage(_all_passages(texts, items, reach).withColumn("passage", _name()), "passages")
        found = passages.select("passage", "id", "at").join(
            stage(_aligned(_candidates(passages, items), least), "aligned"), "passage"
        ).select("id", "item", "score", (F.col("at") + F.col("end") + 1).alias("end"))
    return found.groupBy("id", "item").agg(
        F.max("score").alias("score"), F.max_by("end", F.struct("score", "end")).alias("end_word")
    ).withColumnsRenamed({"id": id_col, "item": f"{item_col}_leaked" if item_col == id_col else item_col})


def _all_passages(texts: DataFrame, items: DataFrame, longest: int) -> DataFrame:
    total = items.agg(F.sum(F.size("runs") + F.size("triples"))).first()[0]
    slices = 1 + total // SLICE
    lengths = [n for (n,) in items.select(F.size("words")).distinct().where(F.size("words") < RUN).collect()]
    made = None
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("words"), F.lit(slices)) == k)
        known = tuple(
            np.sort(part.select(F.explode(c).alias("run")).distinct().toArrow().column(0).to_numpy().view(np.uint64))
            for c in ("runs", "triples"))
        one = _passages(texts, known, lengths, longest)
        made = one if made is None else made.union(one)
    return made


def _name() -> Column:
    """A digest of a passage's words."""
    return F.unhex(F.md5(F.array_join(F.col("words").cast("array<string>"), " ").cast("binary")))


def _candidates(passages: DataFrame, items: DataFrame) -> DataFrame:
    """Each distinct passage beside every item that it shares a run with."""
    # With slices, a passage comes with the runs of each slice.
    def shared(runs: str) -> DataFrame:
        hits = passages.select("passage", F.explode(F.array_distinct(runs)).alias("run")).distinct()
        runs_of = items.select("item", "words", F.explode(F.array_distinct(runs)).alias("run")).select(
            "item", "run", F.xxhash64("words").alias("version"))
        return hits.join(runs_of, "run").groupBy("passage", "item", "version").agg(F.count("*").alias("n"))

    pairs = shared("runs").union(shared("triples").where(F.col("n") >= FEW)).select("passage", "item", "version").distinct()
    distinct = passages.groupBy("passage").agg(F.first("words").alias("words"))
    return (
        pairs.join(distinct, "passage")
        .join(items.select("item", F.xxhash64("words").alias("version"), F.col("words").alias("item_words")), ["item", "version"])
        .select("passage", "item", "words", "item_words")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no test item, all columns as they are."""
    found = leaks(docs, benchmark, id_col=id_col, **options).select(id_col).distinct()
    return docs.join(found, id_col, "left_anti").select(docs.columns)
