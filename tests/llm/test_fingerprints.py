from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from callgrain.llm import fingerprints as fp


def plain(text):
    """The bins of a text by the definition, one step after the other."""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in (text or "").lower()).split(" ") if w]
    codes = [zlib.crc32(w.encode()) for w in words]
    runs = [codes[i:i + 5] for i in range(max(1, len(codes) - 4))] if codes else []
    bins = {}
    for run in runs:
        h = sum(c * f for c, f in zip(run, fp.FACTORS, strict=False)) % fp.PRIME
        bins[h >> 23] = min(h, bins.get(h >> 23, h))
    out = []
    for i in range(fp.BINS) if bins else []:
        p, q = fp.order_of(i)
        out.append(bins[i if i in bins else min(bins, key=lambda b: (p * b + q) % 257)] & 255)
    return out


def bins_of(words):
    return [(w >> (56 - 8 * k)) & 255 for w in words for k in range(8)]


def test_bins_equal_the_plain_rule(strange):
    rows = fp.fingerprints(strange).join(strange.select("doc_id", "text"), "doc_id").collect()
    rng = random.Random(1)
    assert len(rows) >= 10
    texts = {r["text"] for r in strange.collect()}
    for row in fp.fingerprints(strange).select("doc_id", "fingerprint").collect():
        assert bins_of(row["fingerprint"]) in [plain(t) for t in texts]
    sizes = [1, 2, 4, 5, 6, 20, 60, 200, 1000, 5000]
    made = [" ".join(f"w{rng.randrange(9000)}" for _ in range(n)) for n in sizes]
    df = strange.sparkSession.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    for row in fp.fingerprints(df).collect():
        assert bins_of(row["fingerprint"]) == plain(made[row["doc_id"]])


def test_likeness_is_unbiased(spark):
    """Estimates of known similarities, over sizes with many and few empty bins."""
    rng, rows, true = random.Random(2), [], {}
    for k in range(240):
        n = (12, 60, 400, 1500)[k % 4]
        words = [f"{rng.randrange(10 ** 9):x}" for _ in range(n)]
        other = words[:n - n // (2 + k % 3)] + [f"{rng.randrange(10 ** 9):x}" for _ in range(n // (2 + k % 3))]
        a, b = ({tuple(x[i:i + 5]) for i in range(len(x) - 4)} for x in (words, other))
        true[k] = len(a & b) / len(a | b)
        rows.append((k, " ".join(words), " ".join(other)))
    df = spark.createDataFrame(rows, "k int, a string, b string").select(
        "k", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("s"))
    errors = [r["s"] - true[r["k"]] for r in df.collect()]
    assert abs(sum(errors) / len(errors)) < 0.02
    assert max(map(abs, errors)) < 0.3 and (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.07


def test_edited_texts_and_order(strange):
    rows = fp.edited_pairs(strange).withColumn("edited_hash", F.sha2(F.col("edited").cast("binary"), 256)).collect()
    given = sorted({(r["doc_id"], r["text"] or "") for r in strange.collect()}, key=lambda r: -r[0] if r[0] is not None else 1)
    assert len(rows) == strange.count()
    both = {i: sorted(t for k, t in given if k == i) for i, _ in given}
    ids = [i for i in dict.fromkeys(i for i, _ in given)]
    for row in rows:
        i = row["doc_id"]
        if i == 5 or 5 in (ids[(ids.index(i) + 1) % len(ids)],):  # two texts of one id: in the order of their hashes
            continue
        text = both[i][0]
        n = len(text)
        after = both[ids[(ids.index(i) + 1) % len(ids)]][0]
        assert row["edited_hash"] == hashlib.sha256((text[:n - n // 2] + after[:n // 2]).encode()).hexdigest(), i
        assert row["n_chars"] == n and bins_of(row["fingerprint"]) == plain(text)


def test_alone_and_without_rows(documents, spark):
    row = fp.edited_pairs(documents([(1, "abcdef")])).collect()[0]
    assert row["edited"] == "abcabc" and row["next_fingerprint"] == row["fingerprint"]
    assert fp.edited_pairs(documents([(1, "x")]).where("false")).count() == 0
    same = spark.range(1).select(fp.fingerprint(F.lit(" ")).alias("none"), fp.fingerprint(F.lit("a b")).alias("some"))
    row = same.select(fp.likeness("none", "none"), fp.likeness("none", "some"), fp.likeness("some", "some"), fp.as_hex(F.col("none"))).collect()[0]
    assert tuple(row) == (1.0, 0.0, 1.0, "")
