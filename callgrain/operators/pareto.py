"""How few items hold a given share of a total."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window, functions as F

from callgrain.operators.splitting import Runs, cut_large_groups
from callgrain.params import GroupSplit


def pareto_head(items: DataFrame, keys: list[str], value: str, share: float, split: GroupSplit | None = None,
                total: int | None = None, times: str | None = None) -> DataFrame:
    """Per group: `head`, the least number of items, largest first, whose values reach `share` of the
    group's total, and `items`, their number. `head` is null where the total is 0.

    Values are whole numbers or decimals, not negative. Equal values are merged before they are ranked,
    so the ranked rows of a group are its distinct values. Counts have few of these, however many
    contacts a caller has: k distinct counts add up to at least k (k + 1) / 2. Other values may have
    many; with `split`, groups that are too large are cut (`total` is as in `cut_large_groups`). A row may stand for
    several items, whose number is in the column `times`.
    """
    n = F.sum(times) if times else F.count(F.lit(1))
    merged = items.groupBy(*keys, F.col(value).alias("_value")).agg(n.alias("_n"))
    merged = merged.withColumn("_sum", F.col("_value") * F.col("_n"))
    cut = Runs(merged, keys)
    if split is not None:
        # In thousandths, largest first; values that share a thousandth stay together.
        placed = merged.withColumn("_place", (F.col("_value") * -1000).cast("bigint"))
        cut = cut_large_groups(placed, keys, "_place", "_place", split, total)
    group = Window.partitionBy(*cut.group)
    downwards = group.orderBy(F.col("_value").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = cut.rows.withColumns({
        "_reached": F.sum("_sum").over(downwards),
        "_ranked": F.sum("_n").over(downwards),
        "_total": F.sum("_sum").over(group),
    })
    if cut.is_cut:
        ranked = _resume(ranked, cut)
    # Compared as whole multiples (reached * q >= total * p for the share p/q): exact, no division.
    part = Fraction(str(share))
    p, q = part.numerator, part.denominator
    missing = F.col("_total") * p - (F.col("_reached") - F.col("_sum")) * q
    is_last = (missing > 0) & (F.col("_reached") * q >= F.col("_total") * p)
    ranked = ranked.withColumns({
        "_missing": F.when(is_last, missing), "_gain": F.when(is_last, F.col("_value") * q),
    })
    needed = F.expr("_missing div _gain") + F.when(F.col("_missing") % F.col("_gain") > 0, 1).otherwise(0)
    head = F.col("_ranked") - F.col("_n") + needed
    return ranked.groupBy(*keys).agg(F.min(head).alias("head"), F.sum("_n").alias("items"))


def _resume(ranked: DataFrame, cut: Runs) -> DataFrame:
    """Add to the sums of a run those of the runs before it, and take the total of the whole group."""
    by_run = Window.partitionBy(*cut.keys).orderBy(*cut.runs)
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.of_cut_groups.groupBy(*cut.group).agg(F.sum("_sum").alias("sum"), F.sum("_n").alias("n"))
    carried = ends.select(
        *cut.group, F.sum("sum").over(earlier).alias("_sum_before"), F.sum("n").over(earlier).alias("_n_before"),
        F.sum("sum").over(Window.partitionBy(*cut.keys)).alias("_group_total"),
    )
    kinds = {name: ranked.schema[name].dataType for name in ("_reached", "_ranked", "_total")}
    whole = {
        "_reached": F.col("_reached") + F.coalesce("_sum_before", F.lit(0)),
        "_ranked": F.col("_ranked") + F.coalesce("_n_before", F.lit(0)),
        "_total": F.coalesce("_group_total", "_total"),
    }
    return cut.carry(ranked, carried).withColumns({name: whole[name].cast(kinds[name]) for name in kinds})
