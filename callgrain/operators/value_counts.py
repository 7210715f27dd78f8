"""Statistics from counts of values.

Rows are reduced first to one for each value that occurs, with its number in the four fine cells. Totals over
categories are additions of these, so no record is repeated for them, and a group of any size leaves no more
rows than it has distinct values. All seven statistics follow from the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callgrain.functions.stats import EXACT
from callgrain.operators.categories import cell_sums, explode_cells


def value_counts(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per group and value: how often it occurs in each fine cell (`n_{weekday}_{daytime}`). Null is a value here."""
    return rows.groupBy(*keys, value).agg(*cell_sums(n="1L"))


def cells_of_counts(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The nine cells of `value_counts`: group, value, weekday, daytime, `n`."""
    return explode_cells(counts, [*keys, value], ["n"], present=["n"])


def counted_stats(counted: DataFrame, keys: list[str], value: str, n: str = "n", exact: bool = True) -> DataFrame:
    """Mean, spread, median, shape and range per group of rows (`value`, number of times it occurs).

    The median is the lower middle element, exactly. With `exact` the mean comes from a decimal sum; values too large for
    the decimal are left out of the mean. Moments are taken about the mean, in the order of values, so results do not depend on
    the number of partitions. Nulls do not count; a group of nulls has no statistics.

    All windows share one sort; a group has as many rows as it has distinct values.
    """
    group = Window.partitionBy(*keys).orderBy(value)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    v = F.col(value)
    times = F.when(v.isNotNull(), F.col(n))
    x = v.cast("double")
    exactly = v.try_cast(EXACT)
    placed = counted.withColumns({
        "_total": F.sum(times).over(whole), "_upto": F.sum(times).over(upto),
        "_sum": F.sum(x * times).over(whole), "_least": F.min(v).over(whole), "_most": F.max(v).over(whole),
    })
    centre = F.when(F.col("_least") == F.col("_most"), F.col("_least").cast("double")).otherwise(F.col("_sum") / F.col("_total"))
    placed = placed.withColumn("_off", x - centre)

    def moment(k: int) -> Column:
        power = F.col("_off")
        for _ in range(k - 1):
            power = power * F.col("_off")
        return F.sum(power * times)

    if exact:
        mean = F.sum(exactly * times.cast("decimal(12,0)")).cast("double") / F.sum(F.when(exactly.isNotNull(), times))
    else:
        mean = F.max(F.col("_sum") / F.col("_total"))
    sums = placed.groupBy(*keys).agg(
        mean.alias("mean"), F.sum(times).alias("_n"), moment(2).alias("_m2"), moment(3).alias("_m3"), moment(4).alias("_m4"),
        F.min(F.when(F.col("_upto") * 2 >= F.col("_total"), v)).alias("median"), F.min(v).alias("min"), F.max(v).alias("max"))
    n_, m2, m3, m4 = (F.col(c) for c in ("_n", "_m2", "_m3", "_m4"))
    return sums.select(
        *keys, "mean", F.sqrt(m2 / n_).alias("std"), "median",
        F.when(m2 > 0, F.sqrt(n_.cast("double")) * m3 / F.sqrt(m2 * m2 * m2)).alias("skewness"),
        F.when(m2 > 0, n_ * m4 / (m2 * m2) - 3).alias("kurtosis"), "min", "max")
