"""Groups of linked nodes: union-find inside partitions, then stars that shrink until each group has one centre.

No link, group or node passes through the driver; each round's links are a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from callgrain.sources.sinks import stage


def forest(left: list, right: list) -> dict:
    """Union-find: each node's root, the smallest node of its group."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for a, b in zip(left, right):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = [(x, r) for x, r in forest(batch.column(0).to_pylist(), batch.column(1).to_pylist()).items() if x != r]
        kind = batch.schema.field(0).type
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in roots], kind), pa.array([r for _, r in roots], kind)], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of `links` (columns a, b) that is not itself the smallest of its group."""
    kind = links.schema["a"].dataType.simpleString()
    shape = f"a {kind}, b {kind}"
    lowest = F.min("b").over(Window.partitionBy("a"))
    edges = stage(links.where("a <> b").mapInArrow(_local, shape).distinct(), "links")
    while True:
        # Done when every node hangs on one other, which hangs on none. Links always lead to the smaller node.
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("b", F.lit(0), F.lit(1)))
        loose = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if loose.where("up > 1 or (up = 1 and down = 1)").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        # Large star: all larger neighbours of a node move to its smallest neighbour, or to itself.
        both = edges.union(edges.select("b", "a")).withColumn("low", F.least("a", lowest))
        large = both.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).withColumn("low", lowest)
        # Small star: all smaller neighbours of a node, and itself, move to the smallest of them; that one's link takes the node.
        small = large.select(
            F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        edges = stage(small.mapInArrow(_local, shape).distinct(), "links")
