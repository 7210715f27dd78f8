"""Document fingerprints by one-permutation MinHash, with optimal densification and packed low-order bits.

Every 5-word shingle is hashed once, from the checksums of its words. The upper eight bits of the hash name one of 256 bins, and
each bin keeps its smallest hash: one sort of a text's hashes gives all bins. A bin that got none takes over the bin that comes first in an order of its
own: attempt t of bin i looks into bin (a_i * t + b_i) mod 257, which reaches every bin (optimal densification with a
2-universal family). Of each bin the low eight bits are kept: 2,048 bits a document, as 32 integers of 64 bits.

Two bins agree by chance with probability C = 1/256, so `likeness` is (share of equal bins - C) / (1 - C), cut to 0 to 1. Its standard
deviation is about sqrt(p (1 - p) / 256) / (1 - C) for a share p, 0.031 at most.

Everything is DataFrame operations on one row: no shuffle, no Python worker. `edited_pairs` compares documents with the next ones: only
ids and lengths are ranked; texts move once by their key, and of each text the beginning that the document before needs.

Cases: words are what stands between spaces (U+0020, U+0009 to U+000D), in lower case; with fewer than five words all of them are the one
shingle. Null counts as empty. Without words the fingerprint is empty: likeness 1 to another such, else 0. Equal texts have equal
fingerprints. Rows are ordered by descending id (null last), then by a hash of the text; rows with one id and one text count
as one document there, and each of them gets the same result. The only document is its own next one. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from callgrain.llm.ranks import global_rank

SHINGLE = 5
BINS = 256
BITS = 8
#: Shingle hashes are below this prime; the checksum of a word counts times the factor of its place.
PRIME = (1 << 31) - 1
FACTORS = (60493, 1540483, 29837033, 82451107, 101513701)
#: A doubled hash shifted by this many bits is its bin.
_BIN_SHIFT = 24
#: Least prime above BINS.
_TURN = 257
#: Attempts that are looked up one by one; the rest is one minimum over the bins that are not empty.
_ATTEMPTS = 6
_CHANCE = 1 / (1 << BITS)


def order_of(i: int) -> tuple[int, int]:
    """(p, q): bin b comes at place (p * b + q) mod 257 in the order of bin i."""
    p, q = (int(hashlib.md5(f"{i}:{x}".encode()).hexdigest()[:7], 16) for x in "pq")
    return 1 + p % (_TURN - 1), q % _TURN


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column) -> Column:
    """A number below PRIME for each shingle of a text: its words' checksums, each times the factor of its place."""
    def cut(w: Column) -> Column:
        def run(places: list[Column]) -> Column:
            return reduce(add, [c * f for c, f in zip(places, FACTORS, strict=False)]) % PRIME

        # Not slice(), which copies the whole array each time.
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: run([F.get(w, i + k) for k in range(SHINGLE)]))
        short = run([F.coalesce(F.get(w, F.lit(k)), F.lit(0)) for k in range(SHINGLE)])
        return F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, F.array(short)).otherwise(F.array().cast("array<long>"))

    return _let(F.transform(words(text), lambda w: F.crc32(w.cast("binary"))), cut)


def _smallest(hashes: Column) -> Column:
    """The smallest hash of each bin, doubled; the odd end of the bin where it has none."""
    ends = F.lit([((i + 1) << _BIN_SHIFT) - 1 for i in range(BINS)])  # after all hashes of the bin
    return _let(F.sort_array(F.concat(F.transform(hashes, lambda h: h * 2), ends)), lambda s: F.filter(
        s, lambda x, i: F.shiftright(x, _BIN_SHIFT) != F.coalesce(F.shiftright(F.get(s, i - 1), _BIN_SHIFT), F.lit(-1))))


def _densified(firsts: Column) -> Column:
    """Low bits of each bin, as a hexadecimal text."""
    orders = [order_of(i) for i in range(BINS)]
    p, q = (F.lit(list(x)) for x in zip(*orders, strict=True))
    tries = [F.lit([pow(p, -1, _TURN) * (t - q) % _TURN for p, q in orders]) for t in range(_ATTEMPTS)]
    digits, least = F.lit([f"{x:02x}" for x in range(1 << BITS)]), (1 << BITS) - 1
    low = lambda x: F.shiftright(x, 1).bitwiseAND(least)

    def fill(d: Column, full: Column) -> Column:
        def rest(i: Column) -> Column:
            return F.array_min(F.transform(full, lambda x: (
                (F.get(p, i) * F.shiftright(x, _BIN_SHIFT) + F.get(q, i)) % _TURN * (1 << BITS) + low(x)
            ))).bitwiseAND(least)

        return F.transform(d, lambda v, i: F.get(digits, F.coalesce(v, *[F.get(d, F.get(t, i)) for t in tries], rest(i)).cast("int")))

    return F.array_join(_let(firsts, lambda s: _let(
        F.filter(s, lambda x: x.bitwiseAND(1) == 0), lambda full: _let(
            F.transform(s, lambda x: F.when(x.bitwiseAND(1) == 0, low(x))), lambda d: fill(d, full)))), "")


def fingerprint(text: Column) -> Column:
    """32 integers that hold eight bits of each of 256 bins; none for a text without words."""
    def pack(digits: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS * BITS // 64 - 1)), lambda k: F.conv(
            F.substring(digits, k * 16 + 1, F.lit(16)), 16, -10).cast("long"))

    return _let(shingle_hashes(F.coalesce(text.cast("string"), F.lit(""))), lambda h: F.when(
        F.size(h) > 0, _let(_densified(_smallest(h)), pack)).otherwise(F.array().cast("array<long>")))


def as_hex(fp: Column) -> Column:
    """The bins of a fingerprint in order, two hexadecimal digits each."""
    return F.array_join(F.transform(fp, lambda w: F.lpad(F.lower(F.hex(w)), 64 // 4, "0")), "")


def likeness(a: Column | str, b: Column | str) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints, 0 to 1."""
    ones = F.lit(sum(1 << k for k in range(0, 64, BITS))).cast("long")

    def unequal(x: Column, y: Column) -> Column:
        """Of how many bins any bit differs: each bin's bits are folded into its lowest."""
        z = x.bitwiseXOR(y)
        for k in (4, 2, 1):
            z = _or_shifted(z, k)
        return F.bit_count(z.bitwiseAND(ones))

    different = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda acc, n: acc + n)
    raw = (1 - different / BINS - _CHANCE) / (1 - _CHANCE)
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.greatest(raw, F.lit(0.0))).otherwise(
        (F.size(a) == F.size(b)).cast("double"))


def _or_shifted(z: Column, k: int) -> Column:
    return _let(z, lambda z: z.bitwiseOR(F.shiftrightunsigned(z, k)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars (code points), text_hash, fingerprint (array of integers)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col), F.length(text).cast("long").alias("n_chars"), F.xxhash64(text).alias("text_hash"),
        fingerprint(text).alias("fingerprint"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with an edited text: its second half replaced by the beginning of the next document's text.

    One row per document: id, n_chars, edited (text), fingerprint, edited_fingerprint, next_fingerprint.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"), fingerprint(text).alias("fingerprint"))
    known = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.length(text).cast("long").alias("n_chars"))
    ranked = global_rank(known.distinct(), [F.col("id").desc_nulls_last(), F.col("text_hash")], "rank")
    n = ranked.count()
    after = ranked.select(
        ((F.col("rank") + (n - 1)) % max(n, 1)).alias("rank"), F.col("id").alias("next_id"), F.col("text_hash").alias("next_hash"))
    pairs = ranked.join(after, "rank").drop("rank").withColumnRenamed("id", "own_id").withColumnRenamed("text_hash", "own_hash")
    half = F.expr("cast(n_chars div 2 as int)")
    begun = pairs.join(
        texts, F.col("next_id").eqNullSafe(F.col("id")) & (F.col("next_hash") == F.col("text_hash"))).select(
        "own_id", "own_hash", "n_chars", F.substring("text", F.lit(1), half).alias("tail"),
        F.col("fingerprint").alias("next_fingerprint"))
    # Rows that repeat wholly give the same beginning several times.
    begun = begun.dropDuplicates(["own_id", "own_hash"])
    joined = texts.join(begun, F.col("id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
    edited = joined.select(
        F.col("id").alias(id_col), "n_chars", "fingerprint", "next_fingerprint",
        F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), "tail").alias("edited"))
    return edited.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
