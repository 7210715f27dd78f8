"""Merkle manifest of a dataset: a ternary hash tree for each source and one over the sources, stored in van Emde Boas order.

A leaf is the SHA-256 of a row's fields. While a level has several nodes, every three consecutive ones (at the end fewer, even one)
become their hash. Trees are cut into aligned subtrees of HEIGHT levels of edges (729 leaves); each is one row, whose
nodes lie in one array in van Emde Boas order: the subtree is split at half height, the top part comes first, then the bottom
parts from left to right, each stored the same way. `address` computes a node's place, for construction and for retrieval, so that no node
holds a pointer, and a path touches few lines of memory whatever their size. The roots of the blocks are the leaves of the next
level of blocks, until each tree has one block.

At scale: texts are read once, for the leaves. Leaves are ranked by ranges of (source, id), so that a source with a third of all rows is dealt like
any other, and are grouped by block: 729 rows at most. Paths come down from the root blocks one level of blocks at a time: a block gets the
siblings above it once, not once for each leaf. Every level is a table in the shared folder. The driver gets the largest number of
leaves of a tree and the root.

Cases: null fields are `-`, so null and empty differ. Null ids come first in their source; rows of one id follow the hash of their leaf, and
repeated rows are leaves of their own. Null sources are one source, the first. A lone leaf is its tree's root. Without rows
there is no root and no proof. Columns that are not named as fields are not read, and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from callgrain.llm.ranks import global_rank
from callgrain.sources.sinks import stage

FANOUT = 3
#: Levels of edges in a block.
HEIGHT = 6
#: Fields of a leaf, in the order of hashing.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK_COLUMNS = "block long, n long, nodes binary, root binary"


def leaf_hash(fields: list[Column]) -> Column:
    """Hexadecimal SHA-256 of the fields: each `-` if null, else its count of bytes, a colon and the value."""
    def coded(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[coded(c) for c in fields]).cast("binary"), 256)


# The arithmetic of the layout

def nodes_in(levels: int) -> int:
    """Nodes of a complete tree with so many levels of nodes."""
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places in the array of the nodes `index` at `depth` (root: 0) of a block with so many levels of nodes."""
    at = np.zeros_like(index)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        width = FANOUT ** (depth - top)  # nodes of this depth in one bottom part
        at = at + nodes_in(top) + index // width * nodes_in(levels - top)
        index, depth, levels = index % width, depth - top, levels - top
    return at


@lru_cache(maxsize=64)
def _places(levels: int, depth: int) -> list[int]:
    return address(levels, depth, np.arange(FANOUT ** depth)).tolist()


def height_of(n: int, most: int) -> int:
    """Levels of edges in a block of a tree that has n nodes at the block's lowest level."""
    height, reach = 0, 1
    while reach < n and height < most:
        height, reach = height + 1, reach * FANOUT
    return height


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def laid_out(digests: list[str], height: int) -> list[str]:
    """The nodes of a block in van Emde Boas order, hexadecimal; places without a node are zero."""
    nodes = ["0" * 64] * nodes_in(height + 1)
    below = _places(height + 1, height)
    for at, digest in zip(below, digests, strict=False):
        nodes[at] = digest
    count = len(digests)
    for depth in range(height - 1, -1, -1):
        here, count, had = _places(height + 1, depth), -(-count // FANOUT), count
        for i in range(count):
            nodes[here[i]] = _hash("".join([nodes[at] for at in below[FANOUT * i:min(FANOUT * i + FANOUT, had)]]))
        below = here
    return nodes


Step = tuple[str, str]


def _steps(nodes: list[str], count: int, height: int) -> list[list[Step]]:
    """For each leaf of a block the siblings on its left and right, level by level up to the block's root."""
    paths: list[list[Step]] = [[]]
    for depth in range(1, height + 1):
        here, parents = _places(height + 1, depth), paths
        had = -(-count // FANOUT ** (height - depth))
        level = [nodes[at] for at in here[:had]]
        paths = []
        for i in range(had):
            first = i - i % FANOUT
            paths.append([("".join(level[first:i]), "".join(level[i + 1:first + FANOUT])), *parents[i // FANOUT]])
    return paths


def _written(steps: list[Step]) -> str:
    return ";".join([f"{left}|{right}" for left, right in steps])


def _read(path: str) -> list[Step]:
    return [tuple(step.split("|")) for step in path.split(";")] if path else []


def fold(digest: str, steps: list[Step]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in steps:
        digest = _hash(left + digest + right)
    return digest


def _hexes(packed: bytes) -> list[str]:
    text = packed.hex()
    return [text[i:i + 64] for i in range(0, len(text), 64)]


# Blocks as rows

def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & a[c].eqNullSafe(b[c])
    return condition


def _blocks(nodes: DataFrame, carried: list[str], height: int) -> DataFrame:
    """Blocks of (tree, n, pos, digest): n is the number of nodes of the tree at this level. Carried columns become lists."""
    size = FANOUT ** height

    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n, first = table["n"][0].as_py(), table["pos"][0].as_py()
        laid = laid_out([d.hex() for d in table["digest"].to_pylist()], height_of(n, height))
        out = {
            "tree": table["tree"].slice(0, 1), "block": pa.array([first // size]), "n": pa.array([n]),
            "nodes": pa.array([bytes.fromhex("".join(laid))]), "root": pa.array([bytes.fromhex(laid[0])]),
        }
        for c in carried:
            column = table[c].combine_chunks()
            out[c] = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
        return pa.table(out)

    more = "".join(f", {c} array<{_kind(nodes, c)}>" for c in carried)
    block = F.expr(f"pos div {size}")
    return nodes.groupBy("tree", "n", block.alias("block")).applyInArrow(
        make, f"tree {_kind(nodes, 'tree')}, {_BLOCK_COLUMNS}{more}")


def _levels(nodes: DataFrame, carried: list[str], height: int) -> list[DataFrame]:
    """Blocks of all levels, from the leaves to the root blocks; each level is stored."""
    largest, size = nodes.agg(F.max("n")).first()[0] or 0, FANOUT ** height
    levels = [stage(_blocks(nodes, carried, height), "merkle_blocks")]
    while largest > size:
        above = levels[-1].where(F.col("n") > size).select(
            "tree", F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block").alias("pos"), F.col("root").alias("digest"))
        levels.append(stage(_blocks(above, [], height), "merkle_blocks"))
        largest = -(-largest // size)
    return levels


def _roots(levels: list[DataFrame], height: int) -> DataFrame:
    """(tree, digest) of each tree."""
    whole = [b.where(F.col("n") <= FANOUT ** height).select("tree", F.col("root").alias("digest")) for b in levels]
    out = whole[0]
    for more in whole[1:]:
        out = out.unionByName(more)
    return out


def _members(row: dict, height: int) -> tuple[range, list[list[Step]]]:
    """Places of a block's leaves in their tree, and the steps of each up to the block's root."""
    size = FANOUT ** height
    places = range(row["block"] * size, min(row["n"], (row["block"] + 1) * size))
    return places, _steps(_hexes(row["nodes"]), len(places), height_of(row["n"], height))


def _extended(own: list[list[Step]], path: str) -> pa.Array:
    return pa.array([";".join(filter(None, (_written(steps), path))) for steps in own], pa.string())


def _with_paths(levels: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The lowest blocks, each with the siblings over its root as `path`; `above` has (tree, path, subroot) of the trees' roots."""
    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, own = _members(row, height)
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([row["tree"]] * len(own), batch.schema.field("tree").type),
                    "block": pa.array(places, pa.int64()), "path": _extended(own, row["path"]),
                    "subroot": pa.array([row["subroot"]] * len(own), pa.binary())})

    paths, size = None, FANOUT ** height
    for level in reversed(levels):
        # Block rows are counted in hundreds of thousands where leaves are counted in hundreds of millions.
        whole = level.where(F.col("n") <= size)
        placed = whole.join(above, _same(whole, above, "tree")).drop(above["tree"])
        if paths is not None:
            part = level.where(F.col("n") > size)
            placed = placed.unionByName(
                part.join(paths, _same(part, paths, "tree", "block")).drop(paths["tree"]).drop(paths["block"]))
        if level is levels[0]:
            return placed
        kind = _kind(level, "tree")
        paths = stage(placed.select("tree", "block", "n", "nodes", "path", "subroot").mapInArrow(
            children, f"tree {kind}, block long, path string, subroot binary"), "merkle_paths")


@dataclass(frozen=True)
class Manifest:
    """Blocks of the sources' trees and of the tree over the sources, from the leaves up, and the root (hexadecimal)."""

    sources: list[DataFrame]
    top: list[DataFrame]
    ranked: DataFrame
    root: str | None
    height: int


def manifest(leaves: DataFrame, carried: list[str] | None = None, height: int = HEIGHT) -> Manifest:
    """The manifest of (source, id, leaf): leaves are hexadecimal. Carried columns stay beside their leaves in the blocks.

    Blocks have `height` levels of edges, three to that power of leaves.
    """
    carried = ["id", *(carried or [])]
    rows = stage(leaves.select(F.col("source").alias("tree"), F.unhex("leaf").alias("digest"), *carried), "merkle_leaves")
    placed = global_rank(rows, [F.col(c) for c in ("tree", "id", "digest")], "place")
    trees = placed.groupBy("tree").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    nodes = placed.join(trees, _same(placed, trees, "tree")).drop(trees["tree"]).withColumn("pos", F.col("place") - F.col("first"))
    sources = _levels(nodes.select("tree", "n", "pos", "digest", *carried), carried, height)
    ranked = global_rank(_roots(sources, height), [F.col("tree")], "pos")
    n = ranked.count()
    top = _levels(ranked.select(
        F.lit(0).alias("tree"), F.lit(n).cast("long").alias("n"), "pos", "digest"), [], height)
    found = _roots(top, height).first()
    return Manifest(sources, top, ranked, bytes(found["digest"]).hex() if found else None, height)


def proofs(held: Manifest, presented: str | None = None) -> DataFrame:
    """One row per leaf: source, id, leaf, subroot, root, proof_sha256 (of the siblings), folded_root, verified.

    The folded root comes from the carried column `presented` where that has a hash, else from the leaf, and the stored siblings.
    """
    def sources_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, own = _members(row, height)
                yield pa.RecordBatch.from_pydict({"pos": pa.array(places, pa.int64()), "path": _extended(own, row["path"])})

    session, height = held.ranked.sparkSession, held.height
    start = session.range(1).select(
        F.lit(0).alias("tree"), F.lit("").alias("path"), F.lit(None).cast("binary").alias("subroot"))
    by_source = _with_paths(held.top, start, height).select("block", "n", "nodes", "path").mapInArrow(
        sources_of, "pos long, path string")
    above = stage(held.ranked.select("tree", "pos", F.col("digest").alias("subroot")).join(by_source, "pos").drop("pos"), "merkle_paths")
    placed = _with_paths(held.sources, above, height)
    root = held.root
    columns = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("block", "n", "nodes", "path", "subroot")}
                (places, own), nodes, upper = _members(row, height), _hexes(row["nodes"]), _read(row["path"])
                count, levels = len(places), height_of(row["n"], height)
                tail = "".join([left + right for left, right in upper])
                digests = [nodes[at] for at in _places(levels + 1, levels)[:count]]
                shown = [d.hex() if d else None for d in batch.column("presented")[k].as_py()]
                seals, folded = [], []
                for digest, other, steps in zip(digests, shown, own, strict=True):
                    seals.append(_hash("".join([left + right for left, right in steps]) + tail))
                    folded.append(fold(fold(other or digest, steps), upper))
                tree = batch.column("tree")
                yield pa.RecordBatch.from_arrays([
                    pa.array([tree[k].as_py()] * count, tree.type), batch.column("id")[k].values, pa.array(digests, pa.string()),
                    pa.array([row["subroot"].hex()] * count), pa.array([root] * count), pa.array(seals), pa.array(folded),
                ], names=["source", "id", *columns])

    shown = F.col(presented) if presented else F.transform("id", lambda _: F.lit(None).cast("binary"))
    lowest = placed.select("tree", "block", "n", "nodes", "path", "subroot", "id", shown.alias("presented"))
    kinds = f"source {_kind(lowest, 'tree')}, id {lowest.schema['id'].dataType.elementType.simpleString()}"
    return lowest.mapInArrow(prove, f"{kinds}, {', '.join(f'{c} string' for c in columns)}").withColumn(
        "verified", F.col("folded_root") == F.col("root"))
