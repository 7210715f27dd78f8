"""Records seen from the side of each subscriber."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from callgrain.functions.calendar import daytime_label, weekday_label
from callgrain.params import Calendar

# Columns of the one party, and those of the other that take their place seen from the other side.
PARTIES = {
    "caller_id": "recipient_id", "recipient_id": "caller_id",
    "caller_antenna": "recipient_antenna", "recipient_antenna": "caller_antenna",
}


def with_labels(cdr: DataFrame, calendar: Calendar) -> DataFrame:
    """Records that have both ids, with their kind of day and time of day."""
    # As a plain condition (not `dropna`) the scan can skip such rows itself.
    return cdr.where("caller_id IS NOT NULL AND recipient_id IS NOT NULL").withColumns({
        "weekday": weekday_label("day", calendar),
        "daytime": daytime_label("timestamp", calendar),
    })


def directed_interactions(cdr: DataFrame, calendar: Calendar) -> DataFrame:
    """Each record twice: as it is (`out`) and with the two parties exchanged (`in`)."""
    df = with_labels(cdr, calendar)
    kept = [c for c in df.columns if c not in PARTIES]
    outgoing = ", ".join(f"{name} AS {name}" for name in PARTIES)
    incoming = ", ".join(f"{other} AS {name}" for name, other in PARTIES.items())
    views = f"struct('out' AS direction, {outgoing}), struct('in' AS direction, {incoming})"
    return df.selectExpr(*kept, f"inline(array({views}))")


def pair_interactions(cdr: DataFrame, calendar: Calendar) -> DataFrame:
    """Each record once, under its unordered pair (`lo`, `hi`).

    Both parties of a pair see the same sequence of records, so anything that depends on the
    sequence is worked out once per pair, on half the rows, and seen from each side afterwards.
    Only a call to oneself shows both directions in one sequence, and is there twice.
    """
    lo_sent = F.when(
        F.col("caller_id") == F.col("recipient_id"), F.array(F.lit(False), F.lit(True))
    ).otherwise(F.array(F.col("caller_id") < F.col("recipient_id")))
    return with_labels(cdr, calendar).select(
        F.least("caller_id", "recipient_id").alias("lo"),
        F.greatest("caller_id", "recipient_id").alias("hi"),
        "*",
        F.explode(lo_sent).alias("lo_sent"),
    )


def both_sides(pairs: DataFrame) -> DataFrame:
    """Turn pair rows into directed interactions, keeping all further columns (antennas if there are any)."""
    kept = [c for c in pairs.columns if c not in ("lo", "hi", "lo_sent", *PARTIES)]
    antennas = [c for c in ("caller_antenna", "recipient_antenna") if c in pairs.columns]

    def seen_by(me: str, other: str, sent: str) -> str:
        places = "".join(f", if({sent}, {name}, {PARTIES[name]}) AS {name}" for name in antennas)
        return f"struct({me} AS caller_id, {other} AS recipient_id, if({sent}, 'out', 'in') AS direction{places})"

    lo_view, hi_view = seen_by("lo", "hi", "lo_sent"), seen_by("hi", "lo", "NOT lo_sent")
    return pairs.selectExpr(*kept, f"inline(if(lo = hi, array({lo_view}), array({lo_view}, {hi_view})))")
