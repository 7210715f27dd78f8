"""Cutting ordered groups that are too large for one task.

A window over a caller, a pair or a subscriber puts the whole group into one task. That is fine for
ordinary ones, but one number may hold a large part of all records. Such groups are cut into runs
along their order; each run becomes a group of its own, and what a run needs to know about the
records before (or after) it comes from one summary row per run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from callgrain.params import GroupSplit
from callgrain.sources.sinks import stage

@dataclass(frozen=True)
class Runs:
    """Rows of ordered groups; `runs` is empty if no group had to be cut."""

    rows: DataFrame
    keys: list[str]
    runs: list[str] = field(default_factory=list)

    @property
    def is_cut(self) -> bool:
        return bool(self.runs)

    @property
    def group(self) -> list[str]:
        """Columns of the groups that a window may hold whole."""
        return self.keys + self.runs

    @property
    def of_cut_groups(self) -> DataFrame:
        return self.rows.where("_cut")

    def carry(self, rows: DataFrame, summary: DataFrame) -> DataFrame:
        """Attach what each run takes over from its neighbours. Both sides are laid out by run,
        and runs are of limited size, so this join cannot be skewed."""
        return rows.join(summary, self.group, "left")

    def lay_out(self, table: DataFrame, summary: DataFrame) -> DataFrame:
        """Repeat a table with one row per group for each run of the cut groups, so that it joins the rows
        where they already are. `summary` has a row per such run."""
        by_run = table.join(summary.select(*self.group), self.keys, "left")
        return by_run.fillna(0, subset=self.runs)

    def finish(self, rows: DataFrame) -> DataFrame:
        return rows.drop(*self.runs, "_cut")


def cut_large_groups(rows: DataFrame, keys: list[str], time: str, tie: str, split: GroupSplit,
                     total: int | None = None) -> Runs:
    """Cut the groups of `keys` above the size limit into runs along (`time`, `tie`).

    `keys` are never null, `time` and `tie` are whole numbers; `total` is the number of rows, or an upper bound: up to
    the limit no group can exceed it. Each round cuts the parts that are still too large: by time while those rows
    of a part that were seen span more than one value of it, else by `tie`. Sizes and spans are estimated on a share of
    the rows (all of them where the limit is small). Runs follow the order whatever was seen: a part that is cut by
    `tie` keeps rows of earlier and later times in runs of their own on either side. So the cut decides only where
    rows are worked on.
    """
    if total is not None and total <= split.rows_per_group:
        return Runs(rows, keys)
    limit = split.rows_per_group
    share = min(1.0, split.rows_to_see / limit)
    runs: list[str] = []
    # Written once, so that the rounds below do not go through the records again.
    seen = rows.select(*dict.fromkeys([*keys, time, tie]))
    seen = stage(seen.sample(share, seed=1) if share < 1 else seen, "group-sizes")
    while True:
        spans = (
            seen.groupBy(*keys, *runs)
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min(time).alias("time_0"), F.max(time).alias("time_1"),
                F.min(tie).alias("tie_0"), F.max(tie).alias("tie_1"),
            )
            .where(F.col("n") > limit * share)
            .withColumn("_by_time", F.col("time_1") > F.col("time_0"))
            .where(F.col("_by_time") | (F.col("tie_1") > F.col("tie_0")))
        )
        start, end = [F.when(F.col("_by_time"), F.col(f"time_{i}")).otherwise(F.col(f"tie_{i}")) for i in (0, 1)]
        spread = end - start + 1
        step = F.least(F.ceil(spread * (F.lit(limit * share) / F.col("n"))), F.ceil(spread / 2))
        large = stage(
            spans.select(*keys, *runs, "_by_time", F.col("time_0").alias("_time"), start.alias("_start"),
                         end.alias("_end"), step.cast("bigint").alias("_step")),
            "large-groups",
        )
        if large.isEmpty():
            break
        name = f"_run_{len(runs)}"
        rows = _number_runs(rows, large, keys + runs, time, tie, name)
        seen = _number_runs(seen, large, keys + runs, time, tie, name).where("_cut")
        runs = [*runs, name]
    return Runs(rows, keys, runs)


def _number_runs(rows: DataFrame, large: DataFrame, on: list[str], time: str, tie: str, name: str) -> DataFrame:
    last = F.floor((F.col("_end") - F.col("_start")) / F.col("_step"))
    within = F.floor((F.col(tie) - F.col("_start")) / F.col("_step"))
    by_tie: Column = (
        F.when(F.col(time) < F.col("_time"), F.lit(-1)).when(F.col(time) > F.col("_time"), last + 1)
        .otherwise(F.greatest(F.lit(0), F.least(within, last)))
    )
    by_time = F.floor((F.col(time) - F.col("_start")) / F.col("_step"))
    already_cut = F.col("_cut") if "_cut" in rows.columns else F.lit(False)
    # The table of large parts has no hint: Spark broadcasts it if its stored size is small.
    return (
        rows.join(large, on, "left")
        .withColumns({
            name: F.coalesce(F.when(F.col("_by_time"), by_time).otherwise(by_tie), F.lit(0)),
            "_cut": already_cut | F.col("_step").isNotNull(),
        })
        .drop("_by_time", "_time", "_start", "_end", "_step")
    )
