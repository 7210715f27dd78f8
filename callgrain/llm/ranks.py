"""Places of rows in a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callgrain.sources.sinks import stage


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`df` with the place of each row in the given order, from 0, as `name`; stored in the shared folder.

    Rows are dealt by ranges of the whole order, so a frequent first column is cut too. A place is that in the partition plus
    the sizes of the partitions before; these offsets are one row for each partition. The order should be total but for
    rows that are equal.
    """
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (
        placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_at", "_before")
    )
