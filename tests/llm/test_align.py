from __future__ import annotations

import base64
import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from callgrain.llm import align
from callgrain.llm.queries import public_pair


def byte_level():
    """The bytes that the characters of a byte-level vocabulary stand for, by its rule."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in shown}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    return table


def plain(rows):
    """Results by the definition, with the other library for A and a loop over all pairs of each document."""
    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    table, out, counts = byte_level(), [], Counter()

    def b_bytes(i):
        piece = second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()

    def ranges(entries):
        ends = np.cumsum([len(e) for e in entries]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))

    for key, text in rows:
        if not text:
            out.append((key, [], [], [], []))
            continue
        whole = (" " + text).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        ab, bb = [bytes(table[c] for c in first.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
        if b"".join(ab) != whole or b"".join(bb) != whole:
            out.append((key, [], [], [], []))
            continue
        ar, br = ranges(ab), ranges(bb)
        links = [(x, y) for x, (s, e) in zip(a, ar, strict=True) for y, (t, f) in zip(b, br, strict=True) if s < f and t < e]
        counts.update(set(links))
        common = sorted({e for _, e in ar} & {f for _, f in br})
        groups, lo = [], 0
        for end in common:
            groups.append(([x for x, (s, e) in zip(a, ar, strict=True) if lo < e <= end], [y for y, (t, f) in zip(b, br, strict=True) if lo < f <= end]))
            lo = end
        out.append((key, a, b, links, groups))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    join = lambda ids: ",".join(map(str, ids))
    return sorted(((
        key, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
        sha256(";".join(f"{join(x)}|{join(y)}" for x, y in groups).encode()).hexdigest() if a else "")
        for key, a, b, links, groups in out), key=repr)


TEXTS = [
    "Plain words, and some more words.", "", None, " ", "  two  spaces ", "Ünïcödé straße 日本語 \U0001f600́", "<s> </s> <unk> <|endoftext|> <0x0A>",
    "tab\tand\nline\r\n", "▁ already marked", "x\x00y", "1234567890 3.14159", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "  wide", "don't we'll",
]


@pytest.mark.parametrize("size", [1, 40, 1 << 21])
def test_equals_loops(spark, size):
    rng = random.Random(3)
    words = "the a token insulted unhappiness Größe naïve https://example.com/a_b 12,5 été … x".split()
    rows = list(enumerate(TEXTS + [" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(25)] + TEXTS[:1] * 3))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, pack string").repartition(3)
    assert sorted(map(tuple, align.alignments(df, public_pair(), size=size).collect()), key=repr) == plain(rows)


def test_strange_rows(strange):
    rows = [tuple(r) for r in strange.select("doc_id", "text").collect() if len(r["text"] or "") < 10_000]
    found = align.alignments(strange, public_pair()).collect()
    assert len(found) == strange.count() and found[0]["n_a"] is not None
    short = {(r[0], r[1]) for r in rows}
    given = Counter(repr((r[0], r[1], r[2], r[3], r[4], r[7])) for r in plain(rows))
    assert not given - Counter(repr((r[0], r[1], r[2], r[3], r[4], r[7])) for r in map(tuple, found)) and short
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in found)


def test_no_rows(documents):
    assert align.alignments(documents([(1, "x")]).where("false"), public_pair()).count() == 0


def test_both_libraries_give_the_same_ids():
    """A is encoded from ranks; the vocabulary file of the other library gives the same ids for every character."""
    tools = align._tools(public_pair())
    other = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{chr(c)}b 1{chr(c)}2 {chr(c)}{chr(c)}  {chr(c)} ,{chr(c)}." for c in points[::7] + points[:3000]]
    assert [e.ids for e in other.encode_batch_fast(texts, add_special_tokens=False)] == [tools.bpe.encode_ordinary(t) for t in texts]
    assert base64.b64decode(b"IQ==") == tools.a.bytes[0].as_py()


def test_overlaps_of_any_cuts():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n_docs, a_ends, b_ends, docs_a, docs_b, at = 3, [], [], [], [], 0
        for d in range(n_docs):
            size = int(rng.integers(1, 12))
            for ends, docs in ((a_ends, docs_a), (b_ends, docs_b)):
                cuts = sorted({*rng.integers(1, size + 1, 4).tolist(), size})
                ends += [at + c for c in cuts]
                docs += [d] * len(cuts)
            at += size
        starts = [np.array([0, *e[:-1]]) for e in (a_ends, b_ends)]
        left, right = align.overlaps(starts[0], np.array(docs_a), starts[1], np.array(docs_b))
        brute = {(i, j) for i in range(len(a_ends)) for j in range(len(b_ends)) if starts[0][i] < b_ends[j] and starts[1][j] < a_ends[i]}
        assert len(left) == len(brute) and set(zip(left.tolist(), right.tolist(), strict=True)) == brute
