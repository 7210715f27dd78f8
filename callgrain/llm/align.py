"""Two tokenizers over the same texts: which of their tokens cover common bytes, and which pairs of ids do so in many documents.

A is a byte-level BPE over a space and the text, B a sentence-piece model over the text (it puts that space there itself). Tokens
of both are ranges of the same bytes. For a run of documents `pandas.merge_asof`, keyed by document, finds for each token's start the
token of the other side that covers it; both directions together are all overlaps, since of two ranges that overlap one
begins inside the other. Where tokens of both sides end at one byte, a group ends.

Counts over the corpus: tasks gather documents into packs of about PACK links. A pack is one row: the distinct id pairs, in how many of
its documents each occurs, and for each document which of them it holds. Pairs are counted over packs (Spark adds up within tasks first),
the counts go back to the packs as one row for each pack and distinct pair, and there they are added per document. So links are never shuffled
singly, a pair that is in every document costs one row a pack, and no table of pairs is broadcast or collected by this module.

Cases: null and empty texts, and texts whose tokens' bytes are not the space and the text (B changes some characters), have no
tokens: zeros and an empty digest. Strings of special tokens inside texts are plain text. Repeated rows are documents of their own. Very
long texts are one document in one pack. Extra columns are not read, and may have any name.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from callgrain.llm.words import runs
from callgrain.sources.sinks import stage

#: Distinct links of documents in a pack, about; a document is never cut.
PACK = 1 << 21
_CODEC = "zstd"


@dataclass(frozen=True)
class Tokenizers:
    """Where the two vocabularies are: ranks and pattern of A, the model of B."""

    ranks: str
    pattern: str
    model: str


class _Side:
    """The bytes of each id."""

    def __init__(self, entries: list[bytes]):
        self.bytes = pa.array(entries, pa.binary())
        self.lengths = np.array([len(e) for e in entries], np.int64)

    def joined(self, ids: np.ndarray) -> memoryview:
        """The bytes of all these ids on end."""
        _, offsets, data = self.bytes.take(pa.array(ids)).buffers()
        ends = np.frombuffer(offsets, np.int32)
        return memoryview(data).cast("B")[ends[0]:ends[len(ids)]]


class _Tools:
    def __init__(self, given: Tokenizers):
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        with open(given.ranks, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bpe = tiktoken.Encoding("a", pat_str=given.pattern, mergeable_ranks=ranks, special_tokens={})
        entries = [b""] * (max(ranks.values()) + 1)
        for entry, i in ranks.items():
            entries[i] = entry
        self.a = _Side(entries)
        self.model = SentencePieceProcessor(model_file=given.model)
        n = self.model.get_piece_size()
        self.b = _Side([
            bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(n)))])
        # Every id with the mark that may follow it: a comma or the end of its side of the group.
        self.written = pa.array([f"{i}{m}" for size, end in ((len(entries), "|"), (n, ";")) for i in range(size) for m in ("," + end)])


@lru_cache(maxsize=2)
def _tools(given: Tokenizers) -> _Tools:
    return _Tools(given)


def overlaps(a_start: np.ndarray, a_doc: np.ndarray, b_start: np.ndarray, b_doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (place in A, place in B) of tokens that share bytes. Starts ascend over the run; both sides cover the same bytes."""
    a = pd.DataFrame({"at": a_start, "doc": a_doc, "a": np.arange(len(a_start))})
    b = pd.DataFrame({"at": b_start, "doc": b_doc, "b": np.arange(len(b_start))})
    covered = pd.merge_asof(a, b.assign(other=b_start), on="at", by="doc")
    covers = pd.merge_asof(b, a.assign(other=a_start), on="at", by="doc")
    covers = covers[covers["other"] < covers["at"]]  # equal starts are in the first direction already
    return (np.concatenate([covered["a"].to_numpy(), covers["a"].to_numpy()]),
            np.concatenate([covered["b"].to_numpy(), covers["b"].to_numpy()]))


@dataclass
class _Run:
    """Results of a run of documents: figures per document, and their distinct id pairs, document by document."""

    figures: dict[str, np.ndarray]
    digests: list[str]
    per_doc: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def _spread(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in ids], np.int64)
    return np.concatenate(ids) if len(ids) else np.zeros(0, np.int64), sizes


def aligned(texts: list[str | None], given: Tokenizers) -> _Run:
    """Alignment of the texts of one run."""
    tools, n = _tools(given), len(texts)
    a_ids, b_ids = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
    asked = [k for k, t in enumerate(texts) if t]
    for k, found in zip(asked, tools.model.encode([texts[k] for k in asked], num_threads=1), strict=True):
        ids, spaced = np.array(found, np.int64), " " + texts[k]
        raw = spaced.encode()
        if tools.b.lengths[ids].sum() != len(raw) or tools.b.joined(ids) != raw:
            continue
        other = tools.bpe.encode_to_numpy(spaced).astype(np.int64)
        if tools.a.lengths[other].sum() == len(raw) and tools.a.joined(other) == raw:
            a_ids[k], b_ids[k] = other, ids
    a, n_a = _spread(a_ids)
    b, n_b = _spread(b_ids)
    docs = np.arange(n)
    a_doc, b_doc = np.repeat(docs, n_a), np.repeat(docs, n_b)
    a_end, b_end = np.cumsum(tools.a.lengths[a]), np.cumsum(tools.b.lengths[b])
    left, right = overlaps(a_end - tools.a.lengths[a], a_doc, b_end - tools.b.lengths[b], b_doc)

    common = a_end[np.isin(a_end, b_end, assume_unique=True)]
    a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    last_a, last_b = a_end == common[a_group] if len(a) else a_end > 0, b_end == common[b_group] if len(b) else b_end > 0
    # A group's A ids stand before its B ids, groups follow one another.
    a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
    b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
    order = np.empty(len(a) + len(b), np.int64)
    order[a_at], order[b_at] = 2 * a + last_a, 2 * (len(tools.a.lengths) + b) + last_b
    written = tools.written.take(pa.array(order))
    _, offsets, data = written.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(order) + 1] if len(order) else np.zeros(1, np.int32)
    view, bounds = memoryview(data) if data is not None else memoryview(b""), ends[np.concatenate([[0], np.cumsum(n_a + n_b)])]
    digests = [sha256(view[lo:hi - 1]).hexdigest() if hi > lo else "" for lo, hi in zip(bounds, bounds[1:], strict=False)]

    # One sort by (document, A, B): the pair is below 2**31.
    size = len(tools.b.lengths)
    key, times = np.unique((a_doc[left] << 31) | (a[left] * size + b[right]), return_counts=True)
    return _Run(
        {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(a_doc[last_a], minlength=n), "n_links": np.bincount(a_doc[left], minlength=n)},
        digests, np.bincount(key >> 31, minlength=n), key & ((1 << 31) - 1), times)


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _packed(values: np.ndarray) -> bytes:
    raw = values.astype(np.int32).tobytes()
    return pa.compress(raw, _CODEC, asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 4 * n, _CODEC, asbytes=True), np.int32) if n else np.zeros(0, np.int32)


def _pack(name: str, ids: list[pa.Array], held: list[_Run], schema: pa.Schema) -> pa.RecordBatch:
    pairs, place = np.unique(np.concatenate([r.pairs for r in held]), return_inverse=True)
    per_doc = np.concatenate([r.per_doc for r in held])
    # Places ascend within a document, so their steps are small but for the first.
    step = np.diff(place, prepend=0)
    whole = pa.chunked_array(ids).combine_chunks()
    lists = {
        "ids": whole, "digests": pa.array([d for r in held for d in r.digests], pa.string()), "per_doc": pa.array(per_doc, pa.int64()),
        "pairs": pa.array(pairs, pa.int64()), "docs": pa.array(np.bincount(place, minlength=len(pairs)), pa.int64()),
    } | {c: pa.array(np.concatenate([r.figures[c] for r in held]), pa.int64()) for c in _FIGURES}
    out = {c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in lists.items()}
    out |= {"pack": pa.array([name]), "steps": pa.array([_packed(step)]),
            "times": pa.array([_packed(np.concatenate([r.times for r in held]))])}
    return pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in schema], schema=schema)


def packs(docs: DataFrame, given: Tokenizers, id_col: str = "doc_id", text_col: str = "text", size: int = PACK) -> DataFrame:
    """Rows that hold the alignment of many documents each; see the module's text."""
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        held: list[_Run] = []
        links = made = 0
        schema = None

        def full() -> pa.RecordBatch:
            nonlocal made, links
            made += 1
            out = _pack(f"{TaskContext.get().partitionId()}-{made}", ids, held, schema)
            ids.clear()
            held.clear()
            links = 0
            return out

        for batch in batches:
            schema = pa.schema([
                ("pack", pa.string()), ("ids", pa.list_(batch.schema.field("id").type)),
                *[(c, pa.list_(pa.int64())) for c in _FIGURES], ("digests", pa.list_(pa.string())), ("per_doc", pa.list_(pa.int64())),
                ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())), ("steps", pa.binary()), ("times", pa.binary())])
            for lo, hi in runs(batch.column(1)):
                held.append(aligned(batch.column(1).slice(lo, hi - lo).to_pylist(), given))
                ids.append(batch.column(0).slice(lo, hi - lo))
                links += len(held[-1].pairs)
                if links >= size:
                    yield full()
        if held:
            yield full()

    columns = (
        f"pack string, ids array<{kind}>, {', '.join(f'{c} array<long>' for c in _FIGURES)}, digests array<string>, per_doc array<long>, "
        "pairs array<long>, docs array<long>, steps binary, times binary")
    return chosen.mapInArrow(run, columns)


def pair_counts(held: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): in how many documents a pair of ids is linked, and whether that is the most of its A id."""
    counts = held.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.docs").alias("count"))
    # An A id meets at most as many pairs as B has ids.
    return counts.withColumn(
        "best", F.col("count") == F.max("count").over(Window.partitionBy(F.expr(f"pair div {b_size}"))))


def alignments(docs: DataFrame, given: Tokenizers, id_col: str = "doc_id", text_col: str = "text", size: int = PACK) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from sentencepiece import SentencePieceProcessor

    held = stage(packs(docs, given, id_col, text_col, size), "alignment_packs")
    counts = pair_counts(held, SentencePieceProcessor(model_file=given.model).get_piece_size())
    asked = held.select(F.col("pack").alias("of"), F.explode("pairs").alias("pair"))
    answers = asked.join(counts, "pair").select("of", "pair", "count", "best")

    def add_up(pack: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: pack[c].combine_chunks() for c in pack.column_names}
        per_doc = row["per_doc"].values.to_numpy()
        order = np.argsort(found["pair"].to_numpy())
        count = found["count"].to_numpy()[order]
        best = found["best"].to_numpy().astype(bool)[order]
        n = int(per_doc.sum())
        place, times = np.cumsum(_unpacked(row["steps"][0].as_py(), n)), _unpacked(row["times"][0].as_py(), n).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(per_doc)])

        def sums(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(values)])
            return total[ends[1:]] - total[ends[:-1]]

        return pa.table({
            "id": row["ids"].values, **{c: row[c].values for c in _FIGURES}, "n_best": sums(times * best[place]),
            "count_sum": sums(times * count[place]), "groups_sha256": row["digests"].values})

    kind = held.schema["ids"].dataType.elementType.simpleString()
    counted = held.drop("pairs", "docs").groupBy("pack").cogroup(answers.groupBy("of")).applyInArrow(
        add_up, f"id {kind}, {', '.join(f'{c} long' for c in (*_FIGURES, 'n_best', 'count_sum'))}, groups_sha256 string")
    return counted.withColumnRenamed("id", id_col)
