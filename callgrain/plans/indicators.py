"""Mobility indicators per hour, day, week or month.

They read `regional_visits` (all visits, unmapped cells under a fixed region code); those that count visits or
subscribers also take `presence_per_hour` of these, which a job that needs several of them stores once. With
`by_subscriber` counts are kept per subscriber where that changes the grain; `privacy=None` publishes every count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from callgrain.functions.calendar import bucket
from callgrain.operators.numbering import numbered
from callgrain.operators.visits import presence_per_hour, with_buckets, with_neighbours
from callgrain.params import AT_LEAST_15, MORE_THAN_15, UNMAPPED_REGION, GroupSplit, Period, Privacy
from callgrain.plans.regions import _published


def _bucketed(visits: DataFrame, period: Period, frequency: str) -> DataFrame:
    moment = "call_datetime" if "call_datetime" in visits.columns else "hour"
    return visits.where(period.covers(moment)).withColumn(frequency, bucket(moment, frequency))


def transactions(visits: DataFrame, period: Period, frequency: str, privacy: Privacy | None = MORE_THAN_15,
                 by_subscriber: bool = False) -> DataFrame:
    keys = [frequency, "region", *(["msisdn"] if by_subscriber else [])]
    n = F.sum("visits") if "visits" in visits.columns else F.count(F.lit(1))
    counts = _bucketed(visits, period, frequency).groupBy(*keys).agg(n.alias("count"))
    return _published(counts, "count", privacy)


def unique_subscribers(visits: DataFrame, period: Period, frequency: str,
                       privacy: Privacy | None = MORE_THAN_15) -> DataFrame:
    grouped = _bucketed(visits, period, frequency).groupBy(frequency, "region")
    return _published(grouped.agg(F.countDistinct("msisdn").alias("count")), "count", privacy)


def unique_subscribers_country(visits: DataFrame, period: Period, frequency: str,
                               privacy: Privacy | None = MORE_THAN_15) -> DataFrame:
    grouped = _bucketed(visits, period, frequency).groupBy(frequency)
    return _published(grouped.agg(F.countDistinct("msisdn").alias("count")), "count", privacy)


def subscriber_bitmaps(hours: DataFrame) -> DataFrame:
    """Who was where in each hour, as bitmaps: `hour`, `region`, `part`, `seen`, from `presence_per_hour`.

    Subscribers get dense numbers, from 1 here; a bitmap holds 32,768 of them. Bitmaps of hours merge to those of any longer time and of
    all regions, so distinct subscribers of all frequencies come from this table, in which no subscriber occurs any more.
    """
    numbers = numbered(hours, "msisdn")
    # Presence has a subscriber once per hour and region; the tasks merge their bits before anything is exchanged.
    placed = hours.select("msisdn", "hour", "region").join(numbers, "msisdn")
    return placed.groupBy("hour", "region", F.expr("bitmap_bucket_number(number + 1)").alias("part")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(number + 1))").alias("seen"))


def unique_from_bitmaps(bitmaps: DataFrame, period: Period, frequency: str, privacy: Privacy | None = MORE_THAN_15,
                        by_region: bool = True) -> DataFrame:
    """`unique_subscribers`, or `unique_subscribers_country` without `by_region`, from `subscriber_bitmaps`."""
    keys = [frequency, *(["region"] if by_region else [])]
    merged = _bucketed(bitmaps, period, frequency).groupBy(*keys, "part").agg(F.expr("bitmap_or_agg(seen)").alias("seen"))
    counts = merged.groupBy(*keys).agg(F.sum(F.expr("bitmap_count(seen)")).alias("count"))
    return _published(counts, "count", privacy)


def moves_between_days(presence: DataFrame, period: Period, cutoff_days: int = 7) -> DataFrame:
    """Changes of region from one active day of a subscriber to the next, at most `cutoff_days` apart:
    `msisdn`, `connection_date` (of arrival), `region_from`, `region_to`.

    Successive visits on different days are the last of one active day and the first of the next, so
    `presence` (of regional visits) holds all that is needed: the window runs over one row per day.
    Visits of one second are taken in the order of their regions.
    """
    mine = presence.where(period.covers("call_date")).repartition("msisdn")
    days = mine.groupBy("msisdn", "call_date").agg(
        F.min(F.struct("earliest", "region")).alias("first"), F.max(F.struct("latest", "region")).alias("last")
    )
    by_day = Window.partitionBy("msisdn").orderBy("call_date")
    moves = days.withColumn("before", F.lag("last").over(by_day))
    seconds = F.unix_seconds(F.col("first")["earliest"]) - F.unix_seconds(F.col("before")["latest"])
    return moves.where(
        (F.col("before")["region"] != F.col("first")["region"]) & (seconds <= cutoff_days * 24 * 60 * 60)
    ).select(
        "msisdn", F.col("call_date").alias("connection_date"),
        F.col("before")["region"].alias("region_from"), F.col("first")["region"].alias("region_to"),
    )


def origin_destination(presence: DataFrame, period: Period, frequency: str = "day", as_of: Period | None = None,
                       within: Privacy | None = AT_LEAST_15, between: Privacy | None = MORE_THAN_15,
                       cutoff_days: int = 7, by_subscriber: bool = False) -> DataFrame:
    """Connections within days and between days, side by side and summed, from the `presence` of regional
    visits. Within days there are no connections with unmapped cells; `as_of` is their period.

    Both kinds come from one table of subscriber-days, laid out by subscriber, and are counted in one grouping, so presence
    is read once and nothing is joined.
    """
    if frequency != "day":
        raise ValueError("the origin-destination matrix is defined per day only")
    as_of = as_of or period
    mine = presence.where(period.union(as_of).covers("call_date")).repartition("msisdn")
    visited = F.when(F.col("region").isNotNull() & (F.col("region") != UNMAPPED_REGION), F.struct("region", "earliest", "latest"))
    days = mine.groupBy("msisdn", "call_date").agg(
        F.min(F.struct("earliest", "region")).alias("first"), F.max(F.struct("latest", "region")).alias("last"),
        F.collect_list(visited).alias("seen"),
    )
    # Within the period, the day before is the subscriber's last active day of the period.
    by_day = Window.partitionBy("msisdn").orderBy("call_date")
    before = F.lag(F.struct("call_date", "last")).over(by_day)
    placed = days.withColumn("before", before)
    seconds = F.unix_seconds(F.col("first")["earliest"]) - F.unix_seconds(F.col("before")["last"]["latest"])
    moved = (
        period.covers("call_date") & period.covers(F.col("before")["call_date"]) & (seconds <= cutoff_days * 24 * 60 * 60)
        & (F.col("before")["last"]["region"] != F.col("first")["region"])
    )
    start = F.struct(
        F.col("before")["last"]["region"].alias("region"), F.lit(None).cast("timestamp").alias("earliest"),
        F.lit(None).cast("timestamp").alias("latest"))
    places = F.when(as_of.covers("call_date") & (F.size("seen") > 1), F.col("seen")).otherwise(F.array().cast(days.schema["seen"].dataType))
    # A start without times stands for the move from the day before; it leads to the first region of the day alone.
    starts = placed.select(
        "msisdn", "call_date", "seen", "first",
        F.explode(F.concat(places, F.when(moved, F.array(start)).otherwise(F.array().cast(days.schema["seen"].dataType)))).alias("a"))
    is_move = F.col("a")["earliest"].isNull()
    end = F.struct(F.col("first")["region"].alias("region"), F.col("first")["earliest"].alias("earliest"),
                   F.col("first")["earliest"].alias("latest"))
    pairs = starts.select(
        "msisdn", "call_date", "a", is_move.alias("is_move"), F.explode(F.when(is_move, F.array(end)).otherwise(F.col("seen"))).alias("b")
    ).where("is_move OR (a.region <> b.region AND a.earliest < b.latest)")
    keys = ["connection_date", *(["msisdn"] if by_subscriber else []), "region_from", "region_to"]
    counts = pairs.select(
        F.col("call_date").alias("connection_date"), "msisdn", F.col("a.region").alias("region_from"),
        F.col("b.region").alias("region_to"), "is_move",
    ).groupBy(*keys).agg(F.count_if(~F.col("is_move")).alias("subscriber_count"), F.count_if("is_move").alias("od_count"))
    # Counts that are withheld count as none, and connections of which nothing is left are left out.
    for name, privacy in (("subscriber_count", within), ("od_count", between)):
        if privacy is not None:
            counts = counts.withColumn(name, F.when(privacy.allows(name), F.col(name)).otherwise(0))
    return counts.withColumn("total_count", F.col("subscriber_count") + F.col("od_count")).where("total_count > 0").select(
        *keys, "subscriber_count", "od_count", "total_count")


def home_regions(visits: DataFrame, period: Period, frequency: str) -> DataFrame:
    """Per subscriber and bucket: the region that most often holds the last second of a day (`home_region`);
    the one visited latest among equals, then the smallest."""
    hours = visits if "last_visits" in visits.columns else presence_per_hour(visits.where(period.covers("call_datetime")))
    df = _bucketed(hours, period, frequency)
    keys = ["msisdn", "call_date"]
    # At most 24 hours times the number of regions remain per subscriber and day.
    latest = df.groupBy(*keys, frequency, "region").agg(
        F.max("latest").alias("latest"), F.max_by("last_visits", "latest").alias("n")
    ).repartition("msisdn")
    day_end = F.max("latest").over(Window.partitionBy(*keys))
    ends = latest.withColumn("ends", F.when(F.col("latest") == day_end, F.col("n")).otherwise(0))
    counts = ends.groupBy("msisdn", frequency, "region").agg(
        F.sum("ends").alias("ends"), F.max("latest").alias("latest")
    )
    rank = F.struct((-F.col("ends")).alias("order"), (-F.unix_micros("latest")).alias("recency"), "region")
    return counts.groupBy("msisdn", frequency).agg(F.min(rank)["region"].alias("home_region"))


def home_region_counts(visits: DataFrame, period: Period, frequency: str,
                       privacy: Privacy | None = MORE_THAN_15) -> DataFrame:
    homes = home_regions(visits, period, frequency)
    counts = homes.groupBy(frequency, "home_region").agg(F.count(F.lit(1)).alias("count"))
    return _published(counts, "count", privacy)


def enriched_visits(visits: DataFrame, homes: DataFrame, split: GroupSplit, total: int | None = None,
                    fill_ends: bool = True) -> DataFrame:
    """Visits with home region, previous and next visit, and time buckets.

    A subscriber's first visit has no previous region and the last no next one. With `fill_ends` these get the code of
    unmapped cells, as one text column without nulls; else they stay null, unlike those beside an unmapped cell.
    """
    placed = with_buckets(with_neighbours(visits, homes, split, total))
    return placed.fillna(UNMAPPED_REGION, subset=["region_lag", "region_lead"]) if fill_ends else placed
