"""Time between successive interactions of a caller, per type and cell."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callgrain.operators.categories import FINE_CELLS, in_cell, members
from callgrain.operators.splitting import cut_large_groups
from callgrain.params import ALL_DAY, ALL_WEEK, GroupSplit

KEYS = ["caller_id", "txn_type"]
# Stands for a null type while groups are cut, as keys that are null would not join.
NO_TYPE = "\0"


def gaps_between_interactions(directed: DataFrame, split: GroupSplit, total: int | None = None) -> DataFrame:
    """Rows (caller, type, weekday, daytime, `wait`): each interaction under its four cells, with the
    seconds since the cell's previous one.

    One window serves all cells: it keeps the latest time per fine cell, and the latest of a total
    is the latest of its members. So rows are repeated per cell only after the sort.
    """
    rows = directed.select(
        "caller_id", F.coalesce("txn_type", F.lit(NO_TYPE)).alias("txn_type"), "event_id", "weekday", "daytime",
        F.unix_seconds("timestamp").alias("second"),
    )
    cut = cut_large_groups(rows, KEYS, "second", "event_id", split, total)
    latest = {(w, d): f"latest_{w}_{d}" for w, d in FINE_CELLS}
    seen = {name: F.max(F.when(F.expr(in_cell(*cell)), F.col("second"))) for cell, name in latest.items()}
    earlier = Window.partitionBy(*cut.group).orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.rows.withColumns({name: value.over(earlier) for name, value in seen.items()})
    if cut.is_cut:
        earlier_runs = Window.partitionBy(*KEYS).orderBy(*cut.runs).rowsBetween(Window.unboundedPreceding, -1)
        ends = cut.of_cut_groups.groupBy(*cut.group).agg(*[value.alias(name) for name, value in seen.items()])
        carried = ends.select(
            *cut.group, *[F.max(name).over(earlier_runs).alias(f"carried_{name}") for name in latest.values()]
        )
        placed = cut.carry(placed, carried)
        placed = placed.withColumns({name: F.greatest(name, f"carried_{name}") for name in latest.values()})

    def previous(weekday: str | None, daytime: str | None) -> str:
        """Time of the latest interaction with the row's own labels, or any where a total is given."""
        branches = []
        for w, d in FINE_CELLS:
            times = [latest[cell] for cell in members(weekday or w, daytime or d)]
            value = f"greatest({', '.join(times)})" if len(times) > 1 else times[0]
            branches.append(f"WHEN {in_cell(w, d)} THEN {value}")
        return f"CASE {' '.join(branches)} END"

    def quoted(total: str | None, column: str) -> str:
        return f"'{total}' AS {column}" if total else f"{column} AS {column}"

    cells = [
        f"struct({quoted(week, 'weekday')}, {quoted(day, 'daytime')}, second - {previous(week, day)} AS wait)"
        for week in (None, ALL_WEEK) for day in (None, ALL_DAY)
    ]
    placed = placed.withColumn("txn_type", F.nullif("txn_type", F.lit(NO_TYPE)))
    return placed.selectExpr(*KEYS, f"inline(array({', '.join(cells)}))")
