"""Small tables that many features are taken from, each built with one grouping of the records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callgrain.functions.stats import EXACT
from callgrain.operators.categories import CELLS, cell_sums, explode_cells, in_week
from callgrain.operators.interactions import directed_interactions, with_labels
from callgrain.params import ALL_DAY, DAYTIMES, Calendar

def active_day_cells(directed: DataFrame) -> DataFrame:
    """Per caller and cell: distinct active `days`."""
    days = directed.groupBy("caller_id", "day", "weekday").agg(
        *[F.bool_or(F.col("daytime") == d).alias(f"in_{d}") for d in DAYTIMES]
    )

    def active(weekday: str, daytime: str) -> str:
        return in_week(weekday) + ("" if daytime == ALL_DAY else f" AND in_{daytime}")

    counts = days.groupBy("caller_id").agg(
        *[F.expr(f"count_if({active(w, d)}) AS days_{w}_{d}") for w, d in CELLS]
    )
    cells = ", ".join(f"struct('{w}' AS weekday, '{d}' AS daytime, days_{w}_{d} AS days)" for w, d in CELLS)
    return counts.selectExpr("caller_id", f"inline(array({cells}))").where("days > 0")


def activity_cells(directed: DataFrame) -> DataFrame:
    """Per caller, type and cell: interactions `n_out` and `n_in`."""
    sums = directed.groupBy("caller_id", "txn_type").agg(
        *cell_sums(n_out="if(direction = 'out', 1L, 0L)", n_in="if(direction = 'in', 1L, 0L)")
    )
    return explode_cells(sums, ["caller_id", "txn_type"], ["n_out", "n_in"], present=["n_out", "n_in"])


def contact_sums(cdr: DataFrame, calendar: Calendar) -> DataFrame:
    """Per unordered pair (`lo`, `hi`) and type: sums of the four fine cells, one row. No more rows than records."""
    pairs = with_labels(cdr, calendar).groupBy(
        F.least("caller_id", "recipient_id").alias("lo"), F.greatest("caller_id", "recipient_id").alias("hi"),
        "txn_type",
    )
    return pairs.agg(*cell_sums(
        by_lo="if(caller_id <= recipient_id, 1L, 0L)", by_hi="if(caller_id > recipient_id, 1L, 0L)",
        seconds=f"TRY_CAST(duration AS {EXACT})",
    ))


def contact_cells(sums: DataFrame) -> DataFrame:
    """Per caller, contact, type and cell: interactions `n_out`, `n_in`, `n` and call `seconds`, an exact sum.

    From `contact_sums`, seen from both sides only here.
    """
    cells = explode_cells(sums, ["lo", "hi", "txn_type"], ["by_lo", "by_hi", "seconds"], present=["by_lo", "by_hi"])

    def seen_by(me: str, other: str, n_out: str, n_in: str, seconds: str = "seconds") -> str:
        return (f"struct({me} AS caller_id, {other} AS recipient_id, {n_out} AS n_out, {n_in} AS n_in, "
                f"{n_out} + {n_in} AS n, CAST({seconds} AS decimal(32,6)) AS seconds)")

    # A call to oneself counts once in each direction.
    to_self = seen_by("lo", "hi", "by_lo", "by_lo", "seconds * 2")
    views = f"{seen_by('lo', 'hi', 'by_lo', 'by_hi')}, {seen_by('hi', 'lo', 'by_hi', 'by_lo')}"
    return cells.selectExpr(
        "txn_type", "weekday", "daytime", f"inline(if(lo = hi, array({to_self}), array({views})))"
    )


def contact_counts(contacts: DataFrame) -> DataFrame:
    """Per caller, type and cell: `contacts` with the same `n_out` and `n_in`.

    Contacts of one caller take few different pairs of counts, as the counts add up to the caller's interactions.
    """
    return contacts.groupBy("caller_id", "txn_type", "weekday", "daytime", "n_out", "n_in").agg(
        F.count(F.lit(1)).alias("contacts"))


def antenna_sums(cdr: DataFrame, calendar: Calendar) -> DataFrame:
    """Per caller and antenna: interactions in the four fine cells. No antenna is a group of its own."""
    directed = directed_interactions(cdr, calendar)
    return directed.groupBy("caller_id", "caller_antenna").agg(*cell_sums(n="1L"))


def antenna_cells(sums: DataFrame) -> DataFrame:
    """Per caller, antenna and cell: interactions `n`."""
    return explode_cells(sums, ["caller_id", "caller_antenna"], ["n"], present=["n"])
