"""Near-duplicate vectors: sorted projection passes, verified neighbours, unions across passes.

Each pass gives a vector the signs of 32 random projections, and all vectors are ordered by these as one number. A pass finds the
pairs at most WINDOW places apart, and all pairs whose numbers begin with the same bits, as many bits as leave about 64
unlike vectors together; so a dense group is not cut off by the window. Found pairs with cosine of 0.95 or more, in double
precision, are links. A bit of two vectors at the least cosine agrees with probability 1 - acos(least) / pi (0.899 at 0.95), and the
shared bits grow with the logarithm of n, so one pass finds less of them as n grows: there are as many passes as give such a
pair the probability RECALL by equal beginnings alone. For 0.95 these are 12 up to 65,000 vectors, 19 at 1 million, 29 at 10 million,
41 at 100 million. The rows of a pass carry their places in all passes, so their bytes grow with the square of the passes.

A pair counts in the first pass that finds it: the task sees from both vectors' places and bits in the earlier passes whether one
of these had it. So each task adds up numbers of links by vector and emits a forest of its links; no list of pairs is
made, and copies in every component (equal vectors) are one node with a count. Blocks of BLOCK places are compared in one
task; runs that reach over several blocks are compared block against block in tasks of their own.

Cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing, nor do rows without an id:
component_id is their id. Vectors of different length are never linked. Repeated rows are vectors each. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from callgrain.llm.groups import components
from callgrain.llm.ranks import global_rank
from callgrain.llm.words import lists
from callgrain.sources.sinks import stage

BITS = 32
WINDOW = 32
BLOCK = 2048
#: Least probability to find a pair of the least cosine.
RECALL = 0.99
#: Pairs looked at together in a task.
PAIRS = 1 << 20


def shared_bits(count: int) -> int:
    """Bits that leave about 64 of `count` unlike vectors together."""
    return min(BITS, max(0, math.ceil(math.log2(count + 1)) - 6))


def passes_for(count: int, least: float, recall: float = RECALL) -> int:
    """Passes after which a pair of cosine `least` among `count` vectors has had equal shared bits with probability `recall`."""
    agree = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    once = agree ** shared_bits(count)
    if once >= recall:
        return 1
    if once == 0:
        raise ValueError("least must be above -1")
    return math.ceil(math.log1p(-recall) / math.log1p(-once))


def _planes(size: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, size]).standard_normal((size, passes * BITS))


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors (in the last axis) of length 1, in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=-1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True))


def _values(vector: pa.ListScalar) -> np.ndarray:
    """In double precision; empty if null, or if a component is."""
    raw = vector.values
    return raw.to_numpy(zero_copy_only=False).astype(np.float64) if raw is not None and not raw.null_count else np.zeros(0)


def _prepared(vectors: DataFrame) -> DataFrame:
    """(id, node, size, vector): node is a hash of the components, or null for vectors that link with nothing."""
    element = vectors.schema["vector"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size, values = [], [], []
            for vector in batch.column(1):
                x = _values(vector)
                good = len(x) > 0 and np.isfinite(x).all() and x.any()
                if not good:
                    node.append(None), size.append(0), values.append(x[:0])
                    continue
                x = x + 0.0  # one zero
                node.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                size.append(len(x)), values.append(x)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(node, pa.binary()), pa.array(size, pa.int32()),
                lists(np.concatenate(values), np.array([len(v) for v in values]),
                      pa.float32() if element == "float" else pa.float64()),
            ], names=["id", "node", "size", "vector"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, node binary, size int, vector array<{element}>")


def _keys(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """(size, node, keys): the signs of the projections of each pass, as one number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            keys = []
            for vector in batch.column(2):
                x = _values(vector)
                if len(x) not in planes:
                    planes[len(x)] = _planes(len(x), passes, seed)
                signs = (_unit(x) @ planes[len(x)] > 0).reshape(passes, BITS)
                keys.append(signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1),
                lists(np.concatenate(keys or [np.zeros(0, np.int64)]), np.array([len(k) for k in keys], np.int64), pa.int64()),
            ], names=["size", "node", "keys"])

    return nodes.select("size", "node", "vector").mapInArrow(run, "size int, node binary, keys array<long>")


def _compare(least: float, window: int):
    """For one unit (pass p, block i against block j): links and a root of each vector that has any."""
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        p, same = int(unit["pass"].iloc[0]), bool(unit.i.iloc[0] == unit.j.iloc[0])
        vector, place, bits = (np.stack(unit[c].to_numpy()) for c in ("vector", "places", "runs"))
        vector = _unit(vector)
        copies, node = unit["copies"].to_numpy(), unit["node"].to_numpy()
        rows = np.arange(len(unit))
        left = rows if same else rows[(unit.side == 0).to_numpy()]
        right = rows if same else rows[(unit.side == 1).to_numpy()]
        links, root = np.zeros(len(unit), np.int64), rows.copy()
        found = []
        step = max(1, PAIRS // max(1, len(right)))
        for lo in range(0, len(left), step):
            some = left[lo:lo + step]
            a, b = np.nonzero(vector[some] @ vector[right].T >= least)
            a, b = some[a], right[b]
            if same:
                a, b = a[a < b], b[a < b]
            near = (np.abs(place[a] - place[b]) <= window) | (bits[a] == bits[b])
            first = near[:, p] & ~near[:, :p].any(axis=1)
            a, b = a[first], b[first]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            found.append((a, b))
        a, b = (np.concatenate(x) for x in zip(*found)) if found else (rows[:0], rows[:0])
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (root == before).all():
                break
        linked = links > 0
        return pd.DataFrame({"node": node[linked], "links": links[linked], "root": node[root[linked]]})

    return run


def near_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, passes: int = 12,
    window: int = WINDOW, seed: int = 5,
) -> DataFrame:
    """One row per vector: id, n_links, component_id (smallest id of its group), kept (id is the component's).

    `passes` is the least number of passes; there are more where `passes_for` asks for them.
    """
    # Single precision stays as it is while rows move; the arithmetic is in double precision.
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    vector = F.col(vector_col) if single else F.col(vector_col).cast("array<double>")
    made = stage(_prepared(vectors.select(F.col(id_col).alias("id"), vector.alias("vector"))), "vectors")
    good = "node is not null and id is not null"
    nodes = stage(made.where(good).groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("size").alias("size"),
        F.first("vector").alias("vector")), "nodes")
    count = nodes.count()
    bits, passes = shared_bits(count), max(passes, passes_for(count, least))

    ordered = global_rank(
        _keys(nodes, passes, seed).select("size", "node", F.posexplode("keys").alias("pass", "key")),
        [F.col(c) for c in ("size", "pass", "key", "node")], "at")
    begin = ordered.groupBy("size", "pass").agg(F.min("at").alias("begin"))
    # As many rows as there are passes and vector sizes.
    ordered = ordered.join(begin, ["size", "pass"]).select(
        "size", "node", "pass", (F.col("at") - F.col("begin")).alias("place"), F.shiftright("key", BITS - bits).alias("run"))
    ordered = stage(ordered, "ordered")
    span = ordered.groupBy("size", "pass", "run").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    long_runs = span.where(F.floor(F.col("low") / BLOCK) < F.floor(F.col("high") / BLOCK))
    all_places = ordered.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("pass", "place", "run"))).alias("all"))
    rows = (
        ordered.join(long_runs, ["size", "pass", "run"], "left")
        .join(nodes.select("node", "copies", "vector").join(all_places, "node"), "node")
        .select("size", "pass", "place", "node", "copies", "vector", F.col("all.place").alias("places"),
                F.col("all.run").alias("runs"), (F.expr(f"place div {BLOCK}")).alias("block"),
                F.expr(f"coalesce(low, place) div {BLOCK}").alias("low"),
                F.expr(f"coalesce(high, place) div {BLOCK}").alias("high"))
    )
    inside = F.col("place") % BLOCK
    to_right = F.when(inside >= BLOCK - window, F.greatest(F.col("high"), F.col("block") + 1)).otherwise(F.col("high"))
    to_left = F.when(inside < window, F.least(F.col("low"), F.col("block") - 1)).otherwise(F.col("low"))
    to_left = F.greatest(to_left, F.lit(0))
    units = rows.withColumn("unit", F.explode(F.concat(
        F.array(F.struct(F.col("block").alias("i"), F.col("block").alias("j"), F.lit(0).alias("side"))),
        F.when(to_right > F.col("block"), F.transform(
            F.sequence(F.col("block") + 1, to_right), lambda j: F.struct(F.col("block").alias("i"), j.alias("j"), F.lit(0).alias("side"))
        )).otherwise(F.array()),
        F.when(to_left < F.col("block"), F.transform(
            F.sequence(to_left, F.col("block") - 1),
            lambda i: F.struct(i.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"))
        )).otherwise(F.array()),
    ))).select("size", "pass", "unit.*", "node", "copies", "vector", "places", "runs")
    found = stage(units.groupBy("size", "pass", "i", "j").applyInPandas(
        _compare(least, window), "node binary, links long, root binary"), "found")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.select("node", "id", "copies").join(groups, "node", "left").join(links, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least_id = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    by_node = placed.join(least_id, "root").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return made.select("id", F.when(F.expr(good), F.col("node")).alias("node")).join(by_node, "node", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))
