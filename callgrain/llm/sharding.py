"""Shards by proportional stratified interleaving.

Rows are ranked within their source in a seeded random order; row r of a source of n rows has the fractional rank
(r + 0.5) / n. In the order of fractional ranks every stretch has the sources in their proportions, so equal cuts of it give shards
that match the mixture, with row counts at most one apart.

Both orders are global ones, dealt by ranges of (source, hash) and (fraction, source, hash): a source with a third of
all rows is spread like any other rows. Only ids, sizes and hashes move, no texts. Everything is DataFrame operations.

Cases: a null text has size 8 and the checksum of the empty text. Null sources are one source; null ids share one place in the random order and
are told apart by checksum and size. Equal rows are interchangeable. Without rows there are no shards. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callgrain.llm.ranks import global_rank
from callgrain.sources.sinks import stage


def shards(
    docs: DataFrame, n: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """One row per document: id, source, size, text_crc32, shard (0 to n - 1), slot (gapless from 0 in its shard)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("order"),
    )
    rows = stage(rows, "sizes")  # so that the texts are read once
    last = [F.col(c) for c in ("order", "id", "text_crc32", "size")]
    ranked = global_rank(rows, [F.col("source"), *last], "place")
    sources = ranked.groupBy("source").agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    total = sources.agg(F.sum("rows")).first()[0] or 1
    fraction = (F.col("place") - F.col("first") + 0.5) / F.col("rows")
    mixed = ranked.join(
        sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "source", "size", "text_crc32", "order", fraction.alias("fraction"))
    placed = global_rank(mixed, [F.col("fraction"), F.col("source"), *last], "at")
    shard = F.expr(f"at * {n} div {total}")
    return placed.withColumn("shard", shard.cast("int")).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "text_crc32", "shard",
        F.expr(f"at - (cast(shard as long) * {total} + {n - 1}) div {n}").alias("slot"))
