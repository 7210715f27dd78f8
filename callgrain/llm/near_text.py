"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

A document's set is its distinct runs of five words (A-Z lower-cased, words between ASCII white space); a text of fewer words
is one run; a text without words has the empty set and links with nothing. Documents are linked if their sets' similarity
(intersection over union) is at least 0.75.

Signature: element by element, a random permutation spreads the ranks 0, 1, 2, ... over the registers, and a register keeps
the smallest rank plus fraction. As ranks only grow, an element stops once every register holds a smaller rank: long texts
need few ranks per element. Registers of one element are correlated, which makes the estimate's variance smaller than
MinHash's.

Plan: one pass over the texts gives set hash, bands and a sketch of one byte per register. Equal sets become one node. Nodes
that share a band (4 of 128 registers, so a pair at 0.75 shares none of the 32 bands with probability 5e-6) are compared
with the band's centre, the node of smallest hash, not with each other: first each with the centre it shares most bands
with, then with those centres from which it is still apart. Where members of a band are in different groups after that,
blocks of them are compared: by sketch, and those of sketch similarity 0.58 or more by full sets, so a link that no centre shows is
not lost. A block pair returns the few links that join groups, and a block meets itself once, each pair of it once. Rows follow the
members of bands, not the square of a group.
Every link is confirmed on the full sets.

Cases: null or empty text: set size 0, its own group. A row with a null id: linked with nothing, component null, kept. Equal
texts, or texts with equal sets: one group. An id given more than once: each row is judged by its text. Texts of any
length are read whole. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callgrain.llm.groups import components
from callgrain.llm.words import giving_back, grams, lists, mix, runs, words
from callgrain.sources.sinks import stage

REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
#: Elements whose permutations are held at a time.
BLOCK = 1 << 16
#: Shingles of a band's members that meet as many in one task, about.
BLOCK_ITEMS = 1 << 18
#: Registers that agree in the sketches of a pair at 0.75 with probability 1 - 3e-6.
SKETCH_LEAST = int(0.58 * REGISTERS)
_U = np.uint64


def signatures(items: np.ndarray, owner: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash of n sets: rank * 2**32 + fraction for each register. owner: the set of each item."""
    best = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    top = best.reshape(n, m)
    for lo in range(0, len(items), BLOCK):
        item, own = items[lo:lo + BLOCK], owner[lo:lo + BLOCK]
        turn = np.tile(np.arange(m, dtype=np.uint8), (len(item), 1))
        rows, sets = np.arange(len(item)), np.unique(own)
        for j in range(m):
            random = mix(item[rows] + _U((j + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            other = j + (((random & _U(0xFFFFFFFF)) * _U(m - j)) >> _U(32)).astype(np.int64)
            register = turn[rows, other]
            turn[rows, other] = turn[rows, j]
            at = own[rows] * m + register
            value = (_U(j) << _U(32)) | (random >> _U(32))
            lower = value < best[at]
            np.minimum.at(best, at[lower], value[lower])
            # Later ranks are larger: sets whose registers all have a rank up to j are done.
            sets = sets[(top[sets].max(axis=1) >> _U(32)) > j]
            if not len(sets):
                break
            going = np.zeros(n, bool)
            going[sets] = True
            rows = rows[going[own[rows]]]
    return top


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted within it, and their number by text."""
    w = words(column)
    found, at = grams(w, size, short=True)
    text = w.text[at]
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    return found[fresh], np.bincount(text[fresh], minlength=len(column))


def _nodes(found: np.ndarray, count: np.ndarray) -> list[bytes]:
    """A hash of 128 bits for each set."""
    begin = np.concatenate(([0], np.cumsum(count)))
    halves = []
    for seed in (0x51ED270B0F, 0x2545F4914F6CDD1D):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(found + _U(seed)), dtype=np.uint64)))
        halves.append(mix(total[begin[1:]] - total[begin[:-1]] + count.astype(np.uint64)))
    raw = np.stack(halves, axis=1).astype(">u8").tobytes()
    return [raw[k:k + 16] for k in range(0, len(raw), 16)]


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col).cast("string"))


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, text_hash, n, node, bands, sketch) of each document; bands and sketch are null for empty sets."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in runs(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                found, count = shingle_sets(part.column(1), size)
                sign = signatures(found, np.repeat(np.arange(len(count)), count), len(count))
                band = np.zeros((len(count), BANDS), np.uint64)
                for r in range(ROWS):
                    band = mix(band * _U(31) + sign[:, r::ROWS] + np.arange(1, BANDS + 1, dtype=np.uint64))
                sketch = mix(sign).astype(np.uint8)
                has = count > 0
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(2), pa.array(count, pa.int64()), pa.array(_nodes(found, count), pa.binary()),
                    lists(band[has].view(np.int64).ravel(), np.where(has, BANDS, 0), pa.int64()),
                    pa.array([s.tobytes() if h else None for s, h in zip(sketch, has)], pa.binary()),
                ], names=["id", "text_hash", "n", "node", "bands", "sketch"])

    chosen = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), _text_hash(text_col).alias("text_hash"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"id {kind}, text_hash long, n long, node binary, bands array<long>, sketch binary")


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of texts."""
    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in runs(batch.column(0)):
                found, count = shingle_sets(batch.column(0).slice(lo, hi - lo), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_nodes(found, count), pa.binary()), lists(found.view(np.int64), count, pa.int64())],
                    names=["node", "shingles"])

    return texts.mapInArrow(run, "node binary, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"of_{name}"))

    both = F.size(F.array_intersect("of_a", "of_b"))
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .where(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select("a", "b")
    )


def _labelled(df: DataFrame, groups: DataFrame, column: str, name: str) -> DataFrame:
    """With the group of the node in `column` under `name`: its root, or the node itself."""
    known = groups.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return df.join(known, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")


def _meetings(unit: pa.Table) -> tuple[pa.Table, list[tuple[int, int]]]:
    """A unit's rows in order of sides, and for each that meets others its place and that of the first of them; the rest follow.

    A block that meets itself comes once, as side 1: each of its rows meets those after it.
    """
    side = unit["side"].to_numpy()
    if unit["i"][0] == unit["j"][0]:
        return unit, [(x, x + 1) for x in range(len(side) - 1)]
    first = int(np.count_nonzero(side == 0))
    return unit.take(np.argsort(side, kind="stable")), [(x, first) for x in range(first)] if first < len(side) else []


def _plausible(unit: pa.Table) -> pa.Table:
    """Of one unit: the members that are alike by sketch to one of another group, in the first band that the two share."""
    unit, meetings = _meetings(unit)
    sketch = np.frombuffer(b"".join(unit["sketch"].to_pylist()), np.uint8).reshape(len(unit), -1)
    bands = unit["bands"].combine_chunks().flatten().to_numpy().reshape(len(unit), BANDS)
    label = unit["label"].combine_chunks().dictionary_encode().indices.to_numpy()
    here = bands[0] == unit["key"][0].as_py()
    before = bands[:, :int(here.argmax()) if here.any() else 0]
    chosen = np.zeros(len(unit), bool)
    for x, lo in meetings:
        alike = lo + np.flatnonzero(label[lo:] != label[x])
        alike = alike[np.count_nonzero(sketch[alike] == sketch[x], axis=1) >= SKETCH_LEAST]
        alike = alike[~(before[alike] == before[x]).any(axis=1)]
        chosen[alike] = True
        chosen[x] |= len(alike) > 0
    return unit.filter(pa.array(chosen)).select(["key", "i", "j", "side", "node", "label"])


def _joined(percent: int):
    def run(unit: pa.Table) -> pa.Table:
        """Of one unit: pairs of groups that a link joins, as few as do, found by comparing full sets."""
        unit, meetings = _meetings(unit)
        sets, labels = unit["shingles"].combine_chunks(), unit["label"].combine_chunks().dictionary_encode()
        size = np.diff(sets.offsets.to_numpy()).astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(size)))
        # The unit's shingles are numbered: one look at a table tells whether a set has a shingle.
        item = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
        has = np.zeros(len(item), np.int32)
        label, parent = labels.indices.to_numpy(), list(range(len(labels.dictionary)))
        out: list[tuple[int, int]] = []

        def root(x: int) -> int:
            while (up := parent[x]) != x:
                parent[x] = parent[up]
                x = up
            return x

        for x, lo in meetings:
            own = item[begin[x]:begin[x + 1]]
            has[own] = 1
            both = np.add.reduceat(has[item[begin[lo]:]], begin[lo:-1] - begin[lo]).astype(np.int64)
            has[own] = 0
            linked = 100 * both >= percent * (size[lo:] + size[x] - both)
            for other in np.unique(label[lo:][linked]):
                a, b = root(label[x]), root(other)
                if a != b:
                    parent[a] = b
                    out.append((a, b))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": labels.dictionary.take(pa.array(pairs[:, 0])), "b": labels.dictionary.take(pa.array(pairs[:, 1]))})

    return run


def _cross_links(apart: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups joined by a link, of groups with members (key, node, label) in one band.

    A band's members are dealt by hash over blocks of about BLOCK_ITEMS shingles, and blocks meet in pairs. Sketches come first;
    only members with a plausible partner bring their sets, and a unit returns a forest, so rows follow the members.
    """
    rows = apart.join(nodes.select("node", "size", "sketch", "bands"), "node")
    count = rows.groupBy("key").agg((F.floor(F.sum("size") / BLOCK_ITEMS) + 1).cast("int").alias("blocks"))
    rows = rows.join(count, "key").withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    unit = F.explode(F.concat(
        F.transform(F.filter(every, lambda k: k > F.col("block")),
                    lambda k: F.struct(F.col("block").alias("i"), k.alias("j"), F.lit(0).alias("side"))),
        F.transform(F.filter(every, lambda k: k <= F.col("block")),
                    lambda k: F.struct(k.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")))))
    units = rows.withColumn("unit", unit).select("key", "unit.*", "node", "label", "sketch", "bands")
    shape = "key long, i int, j int, side int, node binary, label binary"
    some = units.groupBy("key", "i", "j").applyInArrow(_plausible, shape)
    return some.join(sets, "node").groupBy("key", "i", "j").applyInArrow(_joined(percent), "a binary, b binary")


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(id, text_hash, n, node, label, component_id) of each document; the last three are null without shingles or id."""
    made = stage(sketches(docs, id_col, text_col, size), "sketches")
    named = made.where("n > 0 and id is not null")
    nodes = stage(named.groupBy("node").agg(
        F.min("id").alias("id"), F.first("n").alias("size"), F.first("bands").alias("bands"),
        F.first("sketch").alias("sketch")), "nodes")
    bands = nodes.select("node", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    members = stage(bands.join(shared, "key"), "members")

    chosen = members.select("node").distinct().join(nodes.select("node", "id"), "node")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(
        chosen.select("id"), "id", "left_semi").select("text")
    sets = stage(
        _sets(texts, size).join(chosen.select("node"), "node", "left_semi").groupBy("node").agg(
            F.first("shingles").alias("shingles")), "sets")

    # Dealt by node, which serves both counts.
    edges = stage(
        members.where("node <> hub").select("node", "hub").repartition("node")
        .groupBy("node", "hub").agg(F.count("*").alias("bands"))
        .groupBy("node").agg(
            F.max_by("hub", F.struct("bands", "hub")).alias("best"), F.collect_set("hub").alias("hubs")), "edges")
    first = edges.select(F.col("node").alias("a"), F.col("best").alias("b"))
    links = stage(confirmed(first, sets, percent), "confirmed")
    # Two steps up from centre to centre: what these do not show to be together is compared.
    up = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    groups = _labelled(up, up, "root", "top").select("node", F.col("top").alias("root"))

    rest = edges.select(F.col("node").alias("a"), "best", F.explode("hubs").alias("b")).where("b <> best")
    rest = _labelled(_labelled(rest, groups, "a", "of_a"), groups, "b", "of_b").where("of_a <> of_b").select("a", "b")
    links = stage(links.union(confirmed(rest, sets, percent)), "confirmed")
    groups = components(links)

    tagged = _labelled(members.where("members > 2"), groups, "node", "label")
    mixed = tagged.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    apart = tagged.join(mixed.select("key"), "key", "left_semi").select("key", "node", "label")
    joined = stage(_cross_links(apart, nodes, sets, percent), "joined")

    placed = _labelled(nodes.select("node", "id"), groups, "node", "label")
    if not joined.isEmpty():
        placed = _labelled(placed, components(joined), "label", "top").select("node", "id", F.col("top").alias("label"))
    least = placed.groupBy("label").agg(F.min("id").alias("component_id"))
    by_node = placed.join(least, "label").select("node", "label", "component_id")
    full = made.select("id", "text_hash", "n", F.when(F.expr("n > 0 and id is not null"), F.col("node")).alias("node"))
    return full.join(by_node, "node", "left")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id of its group), kept (id is the component's)."""
    return _grouped(docs, id_col, text_col, size, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, all columns as they are: that of the smallest id, then of a hash of its text.

    Groups are of texts, so two different texts of one id both stay unless they are alike. Of rows with one id and one text one
    stays. Rows without id stay.
    """
    rows = _grouped(docs, id_col, text_col, 5, 75).where("id is not null")
    first = rows.where("label is not null").groupBy("label").agg(
        F.min(F.struct("id", "node", "text_hash")).alias("first")).select("first.id", "first.text_hash")
    kept = first.unionByName(rows.where("label is null").select("id", "text_hash").distinct())
    whole = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), _text_hash(text_col).alias("text_hash"))
    named = whole.join(kept, ["id", "text_hash"], "left_semi").dropDuplicates(["id", "text_hash"])
    return named.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
