"""Text conversations between two parties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callgrain.functions.calendar import daytime_label, weekday_label
from callgrain.operators.categories import cell_sums, explode_cells
from callgrain.operators.interactions import both_sides, pair_interactions
from callgrain.operators.splitting import Runs, cut_large_groups
from callgrain.params import CALL, TEXT, Calendar, FeatureParams, GroupSplit

PAIR = ["lo", "hi"]
# The order of a pair's records. It is total: records of one second follow their id.
ORDER = ["timestamp", "event_id", "lo_sent"]


def _opens(txn_type: Column, second: Column, previous: Column, max_wait: int) -> Column:
    """A text opens a conversation after a call, after silence, or as the first record."""
    return (txn_type == TEXT) & (
        previous["txn_type"].isNull() | (previous["txn_type"] == CALL) | (second - previous["second"] >= max_wait)
    )


def tag_pairs(pairs: DataFrame, max_wait: int, split: GroupSplit, total: int | None = None) -> DataFrame:
    """Add to pair rows: `wait` (seconds since the pair's previous record), `conversation` (epoch second
    of its opening text, for texts) and `answers` (the previous text of the conversation is the other
    party's).
    """
    timed = pairs.withColumn("second", F.unix_seconds("timestamp"))
    cut = cut_large_groups(timed, PAIR, "second", "event_id", split, total)
    order = Window.partitionBy(*cut.group).orderBy(*ORDER)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    is_text = F.col("txn_type") == TEXT

    rows = cut.rows.withColumn("previous", F.lag(F.struct("second", "txn_type")).over(order))
    opens = _opens(F.col("txn_type"), F.col("second"), F.col("previous"), max_wait)
    if cut.is_cut:
        # Whether the first record of a run opens a conversation shows only with the run before it.
        opens = opens & ~(F.col("_cut") & F.col("previous").isNull())
    rows = rows.withColumn("opening", F.when(opens, F.col("second")))
    # Openings grow along the order, so the latest is the largest.
    rows = rows.withColumns({
        "opening_before": F.max("opening").over(earlier),
        "sender_before": F.last(F.when(is_text, F.col("lo_sent")), ignorenulls=True).over(earlier),
    })
    if cut.is_cut:
        rows = _resume(rows, cut, max_wait)

    is_answer = (F.col("sender_before") != F.col("lo_sent")) & F.col("conversation").eqNullSafe(F.col("opening_before"))
    tagged = rows.withColumns({
        "wait": F.col("second") - F.col("previous")["second"],
        "conversation": F.when(is_text, F.greatest("opening_before", "opening")),
    }).withColumn("answers", is_text & F.coalesce(is_answer, F.lit(False)))
    return cut.finish(tagged).drop("second", "previous", "opening", "opening_before", "sender_before")


def _resume(rows: DataFrame, cut: Runs, max_wait: int) -> DataFrame:
    """Complete the columns of `tag_pairs` where a run continues an earlier one."""
    record = F.struct(*ORDER, "second", "txn_type")
    text = F.when(F.col("txn_type") == TEXT, F.struct(*ORDER))
    summary = rows.where("_cut").groupBy(*cut.group).agg(
        F.min(record).alias("first"), F.max(record).alias("last"),
        F.max("opening").alias("opening_inside"), F.max(text).alias("last_text"),
    )
    by_run = Window.partitionBy(*cut.keys).orderBy(*cut.runs)
    earlier_runs = by_run.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("first")
    first_opens = _opens(first["txn_type"], first["second"], F.col("last_before"), max_wait)
    carried = (
        summary.withColumn("last_before", F.lag("last").over(by_run))
        .withColumn("first_opening", F.when(first_opens, first["second"]))
        .withColumn("opening_by_end", F.greatest("opening_inside", "first_opening"))
        .select(
            *cut.group,
            F.struct(F.col("last_before")["second"].alias("second"),
                     F.col("last_before")["txn_type"].alias("txn_type")).alias("carried_previous"),
            "first_opening",
            F.max("opening_by_end").over(earlier_runs).alias("carried_opening"),
            F.last(F.col("last_text")["lo_sent"], ignorenulls=True).over(earlier_runs).alias("carried_sender"),
        )
    )
    rows = cut.carry(rows, carried)
    is_first = F.col("_cut") & F.col("previous").isNull()
    return rows.withColumns({
        "previous": F.coalesce("previous", "carried_previous"),
        "opening": F.when(is_first, F.col("first_opening")).otherwise(F.col("opening")),
        "opening_before": F.greatest(
            "opening_before", F.when(~is_first, F.col("first_opening")), F.col("carried_opening")
        ),
        "sender_before": F.coalesce("sender_before", "carried_sender"),
    }).drop("carried_previous", "first_opening", "carried_opening", "carried_sender")


def tag_conversations(cdr: DataFrame, params: FeatureParams) -> DataFrame:
    """Directed interactions with `wait`, `conversation` and `answers`."""
    pairs = pair_interactions(cdr, params.calendar)
    # Each record is there at most twice; counting the records reads no column of them.
    return both_sides(tag_pairs(pairs, params.max_wait, params.split, total=2 * cdr.count()))


def conversation_openings(tagged_pairs: DataFrame, calendar: Calendar) -> DataFrame:
    """Per caller and cell: opening texts `sent` and `received`, and how many of the latter were `answered`
    (the caller wrote anything in that conversation)."""
    opening = F.col("conversation") == F.unix_seconds("timestamp")
    sent_by_lo = F.col("lo_sent")
    talks = (
        tagged_pairs.where(F.col("conversation").isNotNull())
        .groupBy(*PAIR, "conversation")
        .agg(
            F.count_if(opening & sent_by_lo).alias("lo_opened"), F.count_if(opening & ~sent_by_lo).alias("hi_opened"),
            F.bool_or(sent_by_lo).alias("lo_wrote"), F.bool_or(~sent_by_lo).alias("hi_wrote"),
        )
        .withColumn("start", F.timestamp_seconds("conversation"))
    )

    def seen_by(me: str, other: str) -> str:
        return (f"struct({me} AS caller_id, {me}_opened AS sent, {other}_opened AS received, "
                f"if({me}_wrote, {other}_opened, 0L) AS answered)")

    lo_view, hi_view = seen_by("lo", "hi"), seen_by("hi", "lo")
    sides = talks.select(
        weekday_label("start", calendar).alias("weekday"), daytime_label("start", calendar).alias("daytime"),
        F.expr(f"inline(if(lo = hi, array({lo_view}), array({lo_view}, {hi_view})))"),
    )
    names = ["sent", "received", "answered"]
    sums = sides.groupBy("caller_id").agg(*cell_sums(**{name: name for name in names}))
    return explode_cells(sums, ["caller_id"], names, present=["sent", "received"])
