"""Visits: where a subscriber's records took place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callgrain.functions.calendar import bucket
from callgrain.operators.splitting import cut_large_groups
from callgrain.params import UNMAPPED_REGION, GroupSplit, Period

# The order of a subscriber's visits: total but for visits equal in all of these.
VISIT_ORDER = ["call_datetime", "event_id", "location_id", "region"]


def outgoing_visits(cdr: DataFrame) -> DataFrame:
    """The caller at the caller's antenna."""
    return _visits(cdr, [("caller_id", "caller_antenna")])


def incoming_visits(cdr: DataFrame) -> DataFrame:
    """The recipient at the recipient's antenna."""
    return _visits(cdr, [("recipient_id", "recipient_antenna")])


def visits(cdr: DataFrame, min_id_length: int = 20) -> DataFrame:
    """Outgoing and incoming visits in one scan; only ids of at least the given length (encrypted ones)."""
    both = _visits(cdr, [("caller_id", "caller_antenna"), ("recipient_id", "recipient_antenna")])
    return both.where(F.length("msisdn") >= min_id_length)


def _visits(cdr: DataFrame, sides: list[tuple[str, str]]) -> DataFrame:
    places = ", ".join(f"struct({who} AS msisdn, {where} AS location_id)" for who, where in sides)
    return (
        cdr.selectExpr("event_id", "timestamp AS call_datetime", f"inline(array({places}))")
        .where("location_id IS NOT NULL")
        .selectExpr("msisdn", "call_datetime", "location_id", "CAST(call_datetime AS date) AS call_date", "event_id")
    )


def mapped_visits(visits: DataFrame, cells: DataFrame) -> DataFrame:
    """Visits with their region; those in unmapped cells are left out.

    The map is broadcast if Spark finds it small enough; else the join shuffles, and adaptive
    execution splits cells with many visits.
    """
    return visits.join(cells, F.col("location_id") == F.col("cell_id")).drop("cell_id")


def regional_visits(visits: DataFrame, cells: DataFrame) -> DataFrame:
    """All visits with their region, a fixed code where there is none."""
    joined = visits.join(cells, F.col("location_id") == F.col("cell_id"), "left").drop("cell_id")
    return joined.withColumn("region", F.coalesce("region", F.lit(UNMAPPED_REGION)))


def with_buckets(visits: DataFrame) -> DataFrame:
    """Time buckets of each visit, and the constant 1."""
    return visits.withColumns({
        "hour_of_day": F.hour("call_datetime").cast("byte"),
        **{name: bucket("call_datetime", name) for name in ("hour", "day", "week", "month")},
        "constant": F.lit(1).cast("byte"),
    })


def presence(visits_with_region: DataFrame, period: Period | None = None) -> DataFrame:
    """Per subscriber, date and region: number of visits, earliest and latest.

    The common ground of the regional aggregates. Grouping merges before the shuffle, so a
    subscriber with very many records leaves no more rows than dates times regions.
    """
    df = visits_with_region if period is None else visits_with_region.where(period.covers("call_date"))
    return df.groupBy("msisdn", "call_date", "region").agg(
        F.count(F.lit(1)).alias("visits"),
        F.min("call_datetime").alias("earliest"), F.max("call_datetime").alias("latest"),
    )


def presence_per_hour(visits_with_region: DataFrame) -> DataFrame:
    """Per subscriber, hour and region, as `presence`, and `last_visits`, the number of visits in the latest second.

    Counts by any longer time, `presence` itself and homes follow from it. Visits are counted per second first, as which is the
    latest shows only after grouping; that also spreads the visits of one subscriber.
    """
    seconds = visits_with_region.groupBy("msisdn", "call_date", "region", "call_datetime").agg(F.count(F.lit(1)).alias("n"))
    return seconds.groupBy("msisdn", "call_date", bucket("call_datetime", "hour").alias("hour"), "region").agg(
        F.sum("n").alias("visits"), F.min("call_datetime").alias("earliest"), F.max("call_datetime").alias("latest"),
        F.max_by("n", "call_datetime").alias("last_visits"),
    )


def presence_of_hours(hours: DataFrame) -> DataFrame:
    """`presence` from `presence_per_hour`."""
    return hours.groupBy("msisdn", "call_date", "region").agg(
        F.sum("visits").alias("visits"), F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))


def with_neighbours(visits_with_region: DataFrame, homes: DataFrame, split: GroupSplit,
                    total: int | None = None) -> DataFrame:
    """Add region and time of the subscriber's previous (`_lag`) and next (`_lead`) visit, and the
    subscriber's `home_region`. Visits of one second follow the id of their record.

    Homes come to where the window left the visits, which are shuffled once. `total`, an upper bound of the number of
    visits (twice that of the records), saves estimating the sizes of groups where it is below the limit.
    """
    rows = visits_with_region.withColumn("_second", F.unix_seconds("call_datetime"))
    homes = homes.withColumnRenamed("region", "home_region")
    cut = cut_large_groups(rows, ["msisdn"], "_second", "event_id", split, total)
    visit = F.struct(*VISIT_ORDER)
    by_time = Window.partitionBy(*cut.group).orderBy(*VISIT_ORDER)
    placed = cut.rows.withColumns({"_lag": F.lag(visit).over(by_time), "_lead": F.lead(visit).over(by_time)})
    if cut.is_cut:
        by_run = Window.partitionBy(*cut.keys).orderBy(*cut.runs)
        ends = cut.of_cut_groups.groupBy(*cut.group).agg(F.min(visit).alias("first"), F.max(visit).alias("last"))
        carried = ends.select(
            *cut.group, F.lag("last").over(by_run).alias("_carried_lag"), F.lead("first").over(by_run).alias("_carried_lead")
        )
        placed = cut.carry(placed, carried).withColumns({
            "_lag": F.coalesce("_lag", "_carried_lag"), "_lead": F.coalesce("_lead", "_carried_lead"),
        }).drop("_carried_lag", "_carried_lead")
        homes = cut.lay_out(homes, ends)
    columns = {
        f"{name}{suffix}": F.col(suffix)[name]
        for suffix in ("_lag", "_lead") for name in ("region", "call_datetime")
    }
    placed = placed.withColumns(columns).join(homes, cut.group, "left")
    return cut.finish(placed).drop("_second", "_lag", "_lead")
