"""Token counts: batch encoding inside Arrow functions that return lengths only.

Texts longer than PIECE characters are cut where white space follows a character that is none: byte-level patterns always begin a
new word there, so the pieces' counts add up to the text's. Pieces go to the tokenizer in batches of about BATCH
bytes, so its memory does not follow the size of an Arrow batch or of a text. There is no shuffle.

Cases: null and empty texts have 0 tokens. A long text without white space is one piece. Repeated rows are counted each. Extra
columns are not read.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callgrain.llm.words import runs

PIECE = 1 << 15
BATCH = 1 << 18
_SAFE = re.compile(r"[^\s\x1c-\x1f](?=[ \t\n\r])")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tool = Tokenizer.from_file(path)
        tool.no_truncation()
        tool.no_padding()
        return lambda texts: [len(e) for e in tool.encode_batch_fast(texts, add_special_tokens=False)]
    from sentencepiece import SentencePieceProcessor

    tool = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in tool.encode(texts, num_threads=1)]


def pieces(text: str, most: int = PIECE) -> list[str]:
    """The text cut at safe places, into pieces of about `most` characters."""
    out, at = [], 0
    while len(text) - at > most:
        cut = _SAFE.search(text, at + most)
        if not cut:
            break
        out.append(text[at:cut.end()])
        at = cut.end()
    return [*out, text[at:]]


def counts(texts: list[str | None], path: str) -> np.ndarray:
    """The number of tokens of each text."""
    count, total = _tokenizer(path), np.zeros(len(texts), np.int64)
    waiting: list[str] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        if waiting:
            np.add.at(total, owner, count(waiting))
            waiting.clear()
            owner.clear()

    for k, text in enumerate(texts):
        # Sentence pieces see the whole text; there, no cut is safe.
        for piece in pieces(text) if text and path.endswith(".json") else [text] if text else []:
            waiting.append(piece)
            owner.append(k)
            held += len(piece)
            if held >= BATCH:
                flush()
                held = 0
    flush()
    return total


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, n_bytes (UTF-8), n_tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(batch.column(2).slice(lo, hi - lo).to_pylist(), path) for lo, hi in runs(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(found) if found else [], pa.int64())],
                names=["id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    chosen = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
