"""Dense numbers for the distinct values of a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callgrain.sources.sinks import stage


def numbered(df: DataFrame, column: str, name: str = "number") -> DataFrame:
    """Each distinct value of `column` but null with a number from 0, gapless, in the order of values; stored in the shared folder.

    Values are dealt by ranges. A number is the place in the partition plus the sizes of the partitions before, of which there is
    one row each; so no task sees more than its range.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    placed = stage(
        values.repartitionByRange(column).sortWithinPartitions(column).withColumn("_at", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND((1 << 33) - 1)
    # One row for each partition of the numbers.
    return placed.withColumn("_part", part).join(F.broadcast(sizes), "_part").select(
        column, (F.col("_before") + within).alias(name))
