"""BPE encoding and decoding by dynamic programming over prefixes.

Of all tokens that end a prefix, exactly one is the last token of that prefix's encoding: the one that is compatible with the last
token of the prefix before it. An automaton over all tokens gives the tokens that end each prefix; two tokens are
compatible if no merge across their boundary comes before the merges that build them. The last token of each prefix is
stored, and the ids are read off from the end. This is linear in the length of a word, whatever its merges.

The vocabulary file (JSON, BPE with merges and a suffix for word ends) is a parameter; executors read it at the same
path. Its own normalizer and pre-tokenizer are applied; special tokens in texts are recognized. Words between white space are
encoded once for each run of a batch and kept in a cache of bounded size; ids of words become those of texts, and ids become
strings, on whole columns. A text's encoding needs no shuffle.

Cases: null and empty texts have no tokens and decode to an empty text. Words of any length are encoded whole. Ids that the
vocabulary does not have are left out in decoding. Repeated rows are encoded each. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from callgrain.llm.words import giving_back, lists, runs

#: Words, and parts of words, that a task keeps encoded, twice: those of the current generation and of the one before.
CACHED = 200_000
#: Pairs of tokens that a task keeps tested.
PAIRS = 1 << 19
#: Longer words are not kept.
CACHED_CHARS = 64
#: Rows of a batch are worked on in runs of about this many bytes.
RUN_BYTES = 1 << 21
_END = "\n"
#: What stands before the first token of a word.
_START = -1


class Recent:
    """A dict of bounded size: what was used lately stays, as a full generation becomes the old one and drops the one before."""

    def __init__(self):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.new) > CACHED:
            self.old, self.new = self.new, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of the keys that are not held. The others are in `new` after this."""
        lacking = keys.difference(self.new)
        found = lacking.intersection(self.old)
        self.new.update(zip(found, map(self.old.__getitem__, found)))
        return lacking - found

    def drop_long(self, keys: set[str]) -> None:
        for key in keys:
            if len(key) > CACHED_CHARS:
                self.new.pop(key, None)


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or spec["decoder"] or spec["post_processor"]:
            raise ValueError("needs a BPE vocabulary without subword prefix, decoder and post-processor")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.end = end
        strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        #: By id; null where the vocabulary has none.
        self.strings = pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.string())
        self.has_string = np.array([i in strings for i in range(len(self.strings))])
        self.special = {t["content"]: np.int32(t["id"]).tobytes() for t in spec["added_tokens"]}
        self.special_in = re.compile("(" + "|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) + ")")
        #: Of two tokens, the rank of the merge that joins them; of a token, its rank and halves.
        self.ranks: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.ranks[a, b] = rank
            self.halves.setdefault(whole, (rank, a, b))
        self.fits_known: dict[int, bool] = {}
        made = self._made()
        self.matcher = ahocorasick.Automaton()
        for s, i in vocab.items():
            if i in self.halves and i not in made:
                continue
            text = s[:-len(end)] + _END if end and s.endswith(end) else s
            self.matcher.add_word(text, (i, len(text)))
        self.matcher.make_automaton()
        self.words, self.parts = Recent(), Recent()

    def _edge(self, token: int, right: bool) -> list[tuple[int, float]]:
        """The tokens at the right (left) edge of a token while merges build it, each with the rank of the merge that takes it."""
        out, until = [(token, float("inf"))], float("inf")
        while token in self.halves:
            until, *sides = self.halves[token]
            token = sides[right]
            out.append((token, until))
        return out

    def _fits(self, a: int, b: int, below: float = float("inf")) -> bool:
        """No merge of rank under `below` joins a's right edge to b's left edge before their own merges take these edges.

        Of equal ranks the left one goes first.
        """
        lefts = self._edge(b, False)
        for x, until_x in self._edge(a, True):
            for y, until_y in lefts:
                rank = self.ranks.get((x, y))
                if rank is not None and rank < below and rank < until_x and rank <= until_y:
                    return False
        return True

    def _made(self) -> set[int]:
        """The tokens that merges make of their own text; in that of others, other merges come first."""
        made: set[int] = set()
        for token, (rank, a, b) in sorted(self.halves.items(), key=lambda item: item[1][0]):
            if all(x in made or x not in self.halves for x in (a, b)) and self._fits(a, b, rank):
                made.add(token)
        return made

    def encode_part(self, part: str) -> bytes:
        """Ids of one pre-token, as 32-bit numbers."""
        if not part:
            return b""
        # The mark at the word's end is a character: plain tokens end before it, those with the word's end at it.
        marked = part + _END if self.end else part
        # By the place of a prefix' last character: its last token plus 1. The empty prefix is at -1.
        last = [0] * (len(marked) + 1)
        size = last.copy()
        last[-1] = _START
        if self.end:
            # No plain token is the word's last one.
            last[len(part) - 1] = _START
        known = self.fits_known
        known_fits = known.get
        for at, (token, length) in self.matcher.iter(marked):
            if last[at]:
                continue
            before = last[at - length]
            if not before:
                continue
            pair = before << 32 | token
            fits = known_fits(pair)
            if fits is None:
                if len(known) > PAIRS:
                    known.clear()
                fits = known[pair] = before == _START or self._fits(before - 1, token)
            if fits:
                last[at], size[at] = token + 1, length
        at = len(marked) - 1
        if not last[at]:
            raise ValueError("the vocabulary cannot write this word")
        out = []
        while at >= 0:
            out.append(last[at] - 1)
            at -= size[at]
        return array("i", out[::-1]).tobytes()

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each pre-token."""
        different = set(parts)
        known, encode = self.parts.new, self.encode_part
        for part in self.parts.missing(different):
            known[part] = encode(part)
        out = list(map(known.__getitem__, parts))
        self.parts.drop_long(different)
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space and special tokens; normalized and split in one call each."""
        text = self.normalizer.normalize_str("\n".join(words)) if self.normalizer else "\n".join(words)
        sizes = [len(word) for word in re.split("[ \n]", text)]
        if len(sizes) != len(words):
            if len(words) > 1:
                return [self._encode_words([w])[0] for w in words]
            return [b"".join(self._encode_parts([p for p, _ in self.splitter.pre_tokenize_str(text)]))]
        ends = np.cumsum(np.array(sizes) + 1) - 1
        split = self.splitter.pre_tokenize_str(text)
        ids = self._encode_parts([part for part, _ in split])
        # The parts of a word are those that begin before its end.
        to = np.searchsorted(np.array([start for _, (start, _) in split], np.int64), ends).tolist()
        return [ids[lo] if hi - lo == 1 else b"".join(ids[lo:hi]) for lo, hi in zip([0, *to], to)]

    def _split(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words between white space, on end, and how many each text has."""
        found = pc.utf8_split_whitespace(column)
        # It also splits at four control characters that are no white space to the vocabulary's patterns.
        if pc.any(pc.match_substring_regex(column, "[\x1c-\x1f]")).as_py():
            found = pa.array([re.split("[ \t\n\x0b\x0c\r]+", text) for text in column.to_pylist()], pa.list_(pa.string()))
        words, ends = found.flatten(), np.cumsum(found.value_lengths().to_numpy())
        has = pc.binary_length(words).to_numpy() > 0
        before = np.concatenate(([0], np.cumsum(has)))
        return words.filter(pa.array(has)), np.diff(before[ends], prepend=0)

    def _ids_of_words(self, different: list[str]) -> list[bytes]:
        """Ids of different words, from the cache or encoded now."""
        self.words.turn()
        self.parts.turn()
        need = self.words.missing(set(different))
        known = self.words.new
        # A word with a special token inside is the words between and these tokens.
        special = [w for w in need if self.special_in.search(w)] if self.special_in.search("\n".join(need)) else []
        inner = {w: [p for p in self.special_in.split(w) if p] for w in special}
        pieces = {p for parts in inner.values() for p in parts if p not in self.special}
        plain = list((need | self.words.missing(pieces)).difference(inner))
        if plain:
            known.update(zip(plain, self._encode_words(plain)))
        for word, parts in inner.items():
            known[word] = b"".join(self.special.get(p) or known[p] for p in parts)
        out = list(map(known.__getitem__, different))
        self.words.drop_long(need | pieces)
        return out

    def encoded(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts on end, and how many each has. Each different word is looked up once."""
        words, count = self._split(pc.fill_null(column, "") if column.null_count else column)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(column), np.int64)
        coded = words.dictionary_encode()
        raw, word = self._ids_of_words(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        ids, begin = np.frombuffer(b"".join(raw), np.int32), np.cumsum(size) - size
        taken = size[word]
        until = np.concatenate(([0], np.cumsum(taken)))
        at = np.repeat(begin[word] - until[:-1], taken) + np.arange(until[-1])
        return ids[at], np.diff(until[np.cumsum(count)], prepend=0)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as 32-bit numbers."""
        ids, count = self.encoded(pa.array(texts, pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(count)[:-1])] if texts else []

    def decoded(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Of texts, from their ids on end and the number of each: their tokens with one space between them, as vocabularies
        without a decoder have it."""
        has = (ids >= 0) & (ids < len(self.has_string))
        has[has] = self.has_string[ids[has]]
        if not has.all():
            text = np.repeat(np.arange(len(counts)), counts)[has]
            ids, counts = ids[has], np.bincount(text, minlength=len(counts))
        places = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(places, self.strings.take(pa.array(ids))), " ")

    def decode(self, ids: list[int]) -> str:
        """The text of one list of ids."""
        return self.decoded(np.array(ids, np.int64), np.array([len(ids)]))[0].as_py()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One for each file and Python process."""
    return Codec(path)


def _coded(column: pa.Array, path: str) -> Iterator[tuple[int, int, pa.Array, pa.Array]]:
    """Runs of rows with their ids and the texts decoded from these."""
    tool = codec(path)
    for lo, hi in runs(column, RUN_BYTES):
        ids, counts = tool.encoded(column.slice(lo, hi - lo))
        out = lo, hi, lists(ids, counts, pa.int32()), tool.decoded(ids, counts)
        # What a run's words took is not held beside the next run's.
        pa.default_memory_pool().release_unused()
        yield out


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, `ids`, and `decoded`, the text that these ids give."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, decoded in _coded(batch.column(1), path):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), ids, decoded], names=["id", "ids", "decoded"])

    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def with_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with `token_ids` and `decoded` (columns of these names are replaced)."""
    docs = docs.drop("token_ids", "decoded")
    at = docs.columns.index(text_col)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, ids, decoded in _coded(batch.column(at), path):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, ids, decoded], names=[*batch.schema.names, "token_ids", "decoded"])

    added = [T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *added]))
