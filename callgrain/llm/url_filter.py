"""URL filter: rules first, then a character language-model ratio.

Rules name a host and a beginning of the path and hold for the host and its subdomains; the longest rule wins, the longer host of
equally long ones. URLs that a rule decides are the examples: those allowed and those blocked each train a Markov model over
characters. Its order varies: the distribution after the last `order` characters is smoothed with that after one less, down to
single characters, with a weight that follows how often the context was seen. A URL that no rule decides is
judged by (log-likelihood as accepted - as rejected) / characters; a URL is allowed from the threshold on. The threshold is calibrated
on a fifth of the examples (by checksum of the URL) that train no model: the one with the best mean of both classes' hit rates.

The model is a table: one row for each context, and each context with the next character, that an example has (64-bit hashes of
them), with its counts by class. It grows with what the examples hold; nothing of it is collected, and Spark broadcasts it only if it
finds it small. To score, URLs are cut into blocks of at most BLOCK bytes (or one longer URL). A block asks for each key that it
holds once, so a key that is in every URL comes once for each block; the counts found join their block's URLs again by block. Counting adds
up within runs of rows first.

Cases: a null URL or one without `://` has an empty host and path, fits no rule, and is scored as it stands (null: score 0).
Without examples of both classes the score is 0 and the threshold 0, so such URLs are allowed. Ties and repeated rows are
judged each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from callgrain.llm.words import mix, runs, text_bytes
from callgrain.sources.sinks import stage

ORDER = 4
#: Bytes of URLs that are scored together.
BLOCK = 1 << 18
#: Share of a shorter context's distribution, in characters seen.
PRIOR = 4.0
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass
class Counts:
    """Keys in order, and how often rejected and accepted examples have each."""

    keys: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Counts:
        keys = table.column("key").to_numpy().view(np.uint64)
        n = np.stack([table.column(c).to_numpy() for c in ("rejected", "accepted")], axis=1)
        keys, at = np.unique(keys, return_index=True)
        return cls(keys, n[at].astype(np.float64))

    def __getitem__(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((len(wanted), 2))
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[place] == wanted)[:, None], self.n[place], 0.0)


@dataclass
class Ratio:
    """`counts` has (key, rejected, accepted); `fitted` if both classes have examples."""

    counts: DataFrame
    fitted: bool
    threshold: float = 0.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    place = F.instr(url, "://")
    rest = F.when(place > 0, url.substr(place + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, upper.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict (true: allow) of the rule that decides, or nulls. `rules` is a list that people wrote."""
    text, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host), not r.allow)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, allow = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.allow)).otherwise(allow)
    return text, allow


def _keys(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: keys of contexts, keys of contexts with the next character, and the text of each.

    A text begins after `order` marks, so its first characters have contexts too.
    """
    raw, at = text_bytes(column)
    size = np.diff(at)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(raw)) - at[text] if len(raw) else np.zeros(0, np.int64)
    context = np.zeros(len(raw), np.uint64)
    for order in range(ORDER + 1):
        if order:
            back = np.arange(len(raw)) - order
            char = np.where(place >= order, raw[np.maximum(back, 0)].astype(np.uint64) + _U(2), _U(1))
            context = mix(context * _U(0x100000001B3) + char)
        salted = mix(context + _U(order + 1))
        yield salted, mix(salted + raw.astype(np.uint64) + _U(1)), text


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (url, label): keys of a run of rows with their counts."""
    for batch in batches:
        for lo, hi in runs(batch.column(0)):
            label = batch.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int64)
            for context, following, text in _keys(batch.column(0).slice(lo, hi - lo)):
                for found in (context, following):
                    keys, at = np.unique(found, return_inverse=True)
                    accepted = np.bincount(at, label[text], len(keys)).astype(np.int64)
                    rejected = np.bincount(at, minlength=len(keys)) - accepted
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(rejected), pa.array(accepted)],
                        names=["key", "rejected", "accepted"])


def text_scores(column: pa.Array, counts: Counts) -> np.ndarray:
    """Log-likelihood as accepted less that as rejected, by character; 0 for empty texts."""
    out = np.zeros(len(column))
    for lo, hi in runs(column):
        chance, text = np.full((1, 2), 1 / 256), None
        for context, following, text in _keys(column.slice(lo, hi - lo)):
            chance = (counts[following] + PRIOR * chance) / (counts[context] + PRIOR)
        ratio = np.bincount(text, np.log(chance[:, 1]) - np.log(chance[:, 0]), hi - lo) if len(text) else np.zeros(hi - lo)
        out[lo:hi] = ratio / np.maximum(1, np.bincount(text, minlength=hi - lo))
    return out


def fit(examples: DataFrame, url_col: str = "url", label_col: str = "accepted") -> Ratio:
    """From URLs with labels true (accepted) and false (rejected)."""
    rows = examples.where(F.col(url_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(url_col).cast("string").alias("url"), F.col(label_col).cast("int").alias("label"))
    calibrates = F.crc32(F.col("url").cast("binary")) % 5 == 0
    counts = stage(
        rows.where(~calibrates).mapInArrow(_counted, "key long, rejected long, accepted long")
        .groupBy("key").agg(F.sum("rejected").alias("rejected"), F.sum("accepted").alias("accepted")), "url_counts")
    # Every character has a context of order 0.
    sums = counts.agg(F.max("rejected"), F.max("accepted")).first()
    model = Ratio(counts, bool(sums[0] and sums[1]))
    if not model.fitted:
        return model
    # A histogram of fixed bins of each class.
    scored = score(rows.where(calibrates), model, "url", "label").select(
        "label", F.round(F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.col("score"))) * 100).cast("int").alias("bin"))
    bins = np.zeros((2, 1001))
    for row in scored.groupBy("label", "bin").agg(F.count("*").alias("n")).collect():
        bins[row.label, row.bin + 500] = row.n
    sums = bins.sum(axis=1)
    if (sums > 0).all():
        below = np.concatenate((np.zeros((2, 1)), np.cumsum(bins, axis=1)), axis=1)
        rate = (below[0] / sums[0] + 1 - below[1] / sums[1]) / 2
        best = np.flatnonzero(rate >= rate.max() - 1e-12)
        model.threshold = float((best[np.argmin(np.abs(best - 500))] - 500.5) / 100)  # of the best, nearest to 0
    return model


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their block; the URL is the last column."""
    number = TaskContext.get().partitionId() << 40
    for batch in batches:
        for lo, hi in runs(batch.column(batch.num_columns - 1), BLOCK):
            some = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, number)), *some.columns], names=["_block", *some.schema.names])
            number += 1


def _block_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct keys of each block."""
    for batch in batches:
        block = batch.column(0).to_numpy()
        cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(block))
        for lo, hi in zip(cuts, cuts[1:]):
            column = batch.column(1).slice(lo, hi - lo)
            keys = np.unique(np.concatenate([np.unique(k) for found in _keys(column) for k in found[:2]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), block[lo])), pa.array(keys.view(np.int64))], names=["_block", "key"])


def _scored(rows: pa.Table, found: pa.Table) -> pa.Table:
    rows = rows.drop_columns(["_block"]).combine_chunks()
    urls = rows.column(rows.num_columns - 1)
    urls = urls.combine_chunks() if urls.num_chunks != 1 else urls.chunk(0)
    return rows.append_column("score", pa.array(text_scores(urls, Counts.of(found))))


def score(urls: DataFrame, model: Ratio, url_col: str, *more: str) -> DataFrame:
    """(more..., url, score). Without examples of both classes the score is 0."""
    chosen = urls.select(*more, F.col(url_col).cast("string").alias(url_col))
    if not model.fitted:
        return chosen.withColumn("score", F.lit(0.0))
    blocked = T.StructType([T.StructField("_block", T.LongType()), *chosen.schema.fields])
    rows = stage(chosen.mapInArrow(_in_blocks, blocked), "url_blocks")
    found = rows.select("_block", url_col).mapInArrow(_block_keys, "_block long, key long").join(model.counts, "key")
    return rows.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(
        _scored, T.StructType([*chosen.schema.fields, T.StructField("score", T.DoubleType())]))


def judged(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict (allow or block), score (of the model, for all)."""
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    ruled = urls.select("id", "url", host.alias("host"), path.alias("path"))
    text, allow = rule_of(F.col("host"), F.col("path"), rules)
    ruled = ruled.select("id", "host", "path", text.alias("rule"), allow.alias("allowed"), "url")
    model = fit(ruled, "url", "allowed")
    verdict = F.coalesce("allowed", F.coalesce("score", F.lit(0.0)) >= model.threshold)
    return score(ruled, model, "url", "id", "host", "path", "rule", "allowed").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.when(verdict, "allow").otherwise("block").alias("verdict"), "score")
