"""The category grid: kind of day x time of day (x direction), each with a total."""

from __future__ import annotations

from itertools import combinations, product

from pyspark.sql import Column, DataFrame, functions as F

from callgrain.params import ALL_DAY, ALL_DIR, ALL_WEEK, DAYTIMES, DIRECTIONS, TXN_TYPES, WEEKDAYS

# The labels of each category; the last one is the total of the others.
VOCABULARY = {
    "weekday": (*WEEKDAYS, ALL_WEEK),
    "daytime": (*DAYTIMES, ALL_DAY),
    "direction": (*DIRECTIONS, ALL_DIR),
    "txn_type": TXN_TYPES,
}
FINE_CELLS = tuple(product(WEEKDAYS, DAYTIMES))
CELLS = tuple(product(VOCABULARY["weekday"], VOCABULARY["daytime"]))


def group_with_totals(df: DataFrame, keys: list[str], categories: list[str], *aggregates: Column) -> DataFrame:
    """Group by keys and categories, with a further group for each total of the vocabulary (grouping sets)."""
    kept = [subset for size in range(len(categories) + 1) for subset in combinations(categories, size)]
    marks = [F.grouping(name).alias(f"_all_{name}") for name in categories]
    grouped = df.groupingSets([[*keys, *subset] for subset in kept], *keys, *categories).agg(*aggregates, *marks)
    return grouped.withColumns({
        name: F.when(F.col(f"_all_{name}") == 1, VOCABULARY[name][-1]).otherwise(F.col(name)) for name in categories
    }).drop(*[f"_all_{name}" for name in categories])


def in_week(weekday: str) -> str:
    return "true" if weekday == ALL_WEEK else f"weekday = '{weekday}'"


def in_cell(weekday: str, daytime: str) -> str:
    """SQL condition: a row with fine labels belongs to a cell, which may be a total."""
    return in_week(weekday) + ("" if daytime == ALL_DAY else f" AND daytime = '{daytime}'")


def members(weekday: str, daytime: str) -> list[tuple[str, str]]:
    """The fine cells that a cell is made of."""
    return [(w, d) for w, d in FINE_CELLS if weekday in (w, ALL_WEEK) and daytime in (d, ALL_DAY)]


def cell_sums(**measures: str) -> list[Column]:
    """Sums of each measure (an SQL expression) in the four fine cells, as columns of one group."""
    return [
        F.expr(f"coalesce(sum({measure}) FILTER (WHERE {in_cell(w, d)}), 0) AS {name}_{w}_{d}")
        for name, measure in measures.items() for w, d in FINE_CELLS
    ]


def explode_cells(df: DataFrame, keys: list[str], names: list[str], present: list[str]) -> DataFrame:
    """Rows (keys, weekday, daytime, measures) for the nine cells, from `cell_sums` columns.

    The totals are additions inside the row, so they need no second shuffle. Cells where none of
    the measures in `present` is positive do not occur and are left out.
    """
    def total(name: str, weekday: str, daytime: str) -> str:
        kind = df.schema[f"{name}_{WEEKDAYS[0]}_{DAYTIMES[0]}"].dataType.simpleString()
        parts = " + ".join(f"{name}_{w}_{d}" for w, d in members(weekday, daytime))
        return f"CAST({parts} AS {kind}) AS {name}"

    cells = [
        f"struct('{w}' AS weekday, '{d}' AS daytime, {', '.join(total(name, w, d) for name in names)})"
        for w, d in CELLS
    ]
    occurs = " OR ".join(f"{name} > 0" for name in present)
    return df.selectExpr(*keys, f"inline(array({', '.join(cells)}))").where(occurs)


def widen(long: DataFrame, feature: str, categories: list[str], values: list[str],
          txn_types: tuple[str, ...] = TXN_TYPES) -> DataFrame:
    """One row per caller, one column `{feature}_{categories}[_{value}]` per cell, all of them present.

    One aggregation over a numbered cell; a pivot would shuffle twice, or look up the labels first.
    """
    vocabularies = [txn_types if c == "txn_type" else VOCABULARY[c] for c in categories]
    cell = F.lit(0)
    for category, vocabulary in zip(categories, vocabularies):
        # Null, hence in no cell, for a label outside the vocabulary.
        known = ", ".join(f"'{label}'" for label in vocabulary)
        position = F.expr(f"nullif(array_position(array({known}), {category}), 0)")
        cell = cell * len(vocabulary) + position - 1
    columns = []
    for number, labels in enumerate(product(*vocabularies)):
        for value in values:
            name = "_".join([feature, *labels, *([value] if len(values) > 1 else [])])
            columns.append(F.expr(f"max({value}) FILTER (WHERE _cell = {number}) AS `{name}`"))
    return long.withColumn("_cell", cell).groupBy("caller_id").agg(*columns)
