"""Regional aggregates of subscribers, residents, visitors and connections.

All start from `presence`: one row per subscriber, date and region. Residents and visitors take homes from a table, or
from presence that `with_homes` has marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from callgrain.params import AT_LEAST_15, Period, Privacy


def _published(df: DataFrame, count: str, privacy: Privacy | None) -> DataFrame:
    return df if privacy is None else df.where(privacy.allows(count))


def _in(presence: DataFrame, period: Period | None) -> DataFrame:
    return presence if period is None else presence.where(period.covers("call_date"))


def subscribers_per_region_per_day(presence: DataFrame, period: Period | None = None,
                                   privacy: Privacy | None = AT_LEAST_15) -> DataFrame:
    # Presence holds each subscriber once per date and region, so counting rows counts subscribers.
    counts = _in(presence, period).groupBy(F.col("call_date").alias("visit_date"), "region").agg(
        F.count("msisdn").alias("subscriber_count")
    )
    return _published(counts, "subscriber_count", privacy)


def _week_keys(iso_year: bool) -> dict[str, Column]:
    year = {"visit_year": F.expr("extract(YEAROFWEEK FROM call_date)")} if iso_year else {}
    return {**year, "visit_week": F.weekofyear("call_date")}


def subscribers_per_region_per_week(presence: DataFrame, period: Period | None = None,
                                    privacy: Privacy | None = AT_LEAST_15, iso_year: bool = False) -> DataFrame:
    """By ISO week number. Weeks of different years share a number unless `iso_year` is added to the key."""
    keys = _week_keys(iso_year)
    weekly = _in(presence, period).select(*[k.alias(n) for n, k in keys.items()], "region", "msisdn")
    counts = weekly.groupBy(*keys, "region").agg(F.countDistinct("msisdn").alias("subscriber_count"))
    return _published(counts, "subscriber_count", privacy)


def home_locations(presence: DataFrame, period: Period | None = None) -> DataFrame:
    """The region where a subscriber's days end most often; the most recent one among equals, then the
    smallest. A day ends at its latest visit (the smallest region among simultaneous ones)."""
    # Presence is small per subscriber, so one shuffle by subscriber serves all three groupings.
    mine = _in(presence, period).repartition("msisdn")
    day_end = F.struct((-F.unix_micros("latest")).alias("order"), "region")
    ends = mine.groupBy("msisdn", "call_date").agg(F.min(day_end)["region"].alias("region"))
    times = ends.groupBy("msisdn", "region").agg(
        F.count(F.lit(1)).alias("total"), F.max("call_date").alias("latest_date")
    )
    rank = F.struct((-F.col("total")).alias("order"), (-F.unix_date("latest_date")).alias("recency"), "region")
    return times.groupBy("msisdn").agg(F.min(rank)["region"].alias("region"))


def with_homes(presence: DataFrame, period: Period | None = None) -> DataFrame:
    """Presence with `home_region`, by the rule of `home_locations` over `period`, and whether a row is `at_home`.

    Windows over a subscriber's presence, laid out once: the records need not be read again to find the homes.
    """
    mine = presence.repartition("msisdn")
    counted = F.lit(True) if period is None else period.covers("call_date")
    day = Window.partitionBy("msisdn", "call_date")
    end = F.min(F.struct((-F.unix_micros("latest")).alias("order"), "region")).over(day)["region"]
    ends = mine.withColumn("_ends", counted & F.col("region").eqNullSafe(end))
    place = Window.partitionBy("msisdn", "region")
    total, last = F.count_if("_ends").over(place), F.max(F.when(F.col("_ends"), F.col("call_date"))).over(place)
    ranked = ends.withColumn("_rank", F.struct((-total).alias("order"), (-F.unix_date(last)).alias("recency"), "region"))
    best = F.min(F.when(F.col("_ends"), F.col("_rank"))).over(Window.partitionBy("msisdn"))
    return ranked.withColumn("home_region", best["region"]).withColumn(
        "at_home", F.coalesce(F.col("region") == F.col("home_region"), F.lit(False))).drop("_ends", "_rank")


def homes_of(marked: DataFrame) -> DataFrame:
    """`home_locations` from `with_homes`."""
    found = marked.where(F.col("home_region").isNotNull()).groupBy("msisdn")
    return found.agg(F.first("home_region").alias("region"))


def at_home(presence: DataFrame, homes: DataFrame | None) -> DataFrame:
    """Presence of subscribers in their home region; homes are given, or marked by `with_homes`."""
    return presence.where("at_home") if homes is None else presence.join(homes, ["msisdn", "region"], "left_semi")


def residents_per_region_per_day(presence: DataFrame, homes: DataFrame | None = None, period: Period | None = None,
                                 privacy: Privacy | None = AT_LEAST_15) -> DataFrame:
    return subscribers_per_region_per_day(at_home(presence, homes), period, privacy)


def residents_per_region_per_week(presence: DataFrame, homes: DataFrame | None = None, period: Period | None = None,
                                  privacy: Privacy | None = AT_LEAST_15, iso_year: bool = False) -> DataFrame:
    return subscribers_per_region_per_week(at_home(presence, homes), period, privacy, iso_year)


def _with_home_mark(presence: DataFrame, homes: DataFrame | None) -> DataFrame:
    if homes is None:
        return presence
    return presence.join(homes.withColumn("at_home", F.lit(True)), ["msisdn", "region"], "left")


def _visitors(marked: DataFrame, keys: list, privacy: Privacy | None, inner: Privacy | None) -> DataFrame:
    """Subscribers less residents, both counted in one grouping. Each subscriber is there once per group."""
    counts = marked.groupBy(*keys).agg(
        F.count("msisdn").alias("everyone"), F.count_if(F.col("at_home")).alias("residents")
    )
    if inner is not None:
        # Withheld totals give no row, withheld residents count as none.
        counts = counts.where(inner.allows("everyone"))
        counts = counts.withColumn("residents", F.when(inner.allows("residents"), F.col("residents")).otherwise(0))
    counts = counts.withColumn("subscriber_count", F.col("everyone") - F.col("residents"))
    return _published(counts.drop("everyone", "residents"), "subscriber_count", privacy)


def visitors_per_region_per_day(presence: DataFrame, homes: DataFrame | None = None, period: Period | None = None,
                                privacy: Privacy | None = AT_LEAST_15, threshold_inputs: bool = True) -> DataFrame:
    marked = _with_home_mark(_in(presence, period), homes)
    keys = [F.col("call_date").alias("visit_date"), "region"]
    return _visitors(marked, keys, privacy, privacy if threshold_inputs else None)


def visitors_per_region_per_week(presence: DataFrame, homes: DataFrame | None = None, period: Period | None = None,
                                 privacy: Privacy | None = AT_LEAST_15, threshold_inputs: bool = True,
                                 iso_year: bool = False) -> DataFrame:
    keys = _week_keys(iso_year)
    mark = [] if homes is not None else ["at_home"]
    weekly = _in(presence, period).select(*[k.alias(n) for n, k in keys.items()], "region", "msisdn", *mark).distinct()
    marked = _with_home_mark(weekly, homes)
    return _visitors(marked, [*keys, "region"], privacy, privacy if threshold_inputs else None)


#: Regions of a subscriber-day that are paired in one row.
BLOCK = 256


def region_sets(presence: DataFrame) -> DataFrame:
    """Per date: each set of two and more regions (`seen`, sorted) and how many subscribers were seen in just these."""
    days = presence.where("region IS NOT NULL").groupBy("msisdn", "call_date").agg(
        F.sort_array(F.collect_set("region")).alias("seen"))
    return days.where(F.size("seen") > 1).groupBy("call_date", "seen").agg(F.count(F.lit(1)).alias("subscribers"))


def region_pairs_per_day(presence: DataFrame, period: Period | None = None,
                         privacy: Privacy | None = AT_LEAST_15) -> DataFrame:
    """Subscribers seen in both regions of an unordered pair on a day.

    Many subscribers share a set of regions; each set of a day is taken apart once, and its pairs count for all of them.
    """
    sets = region_sets(_in(presence, period))
    first = sets.select("call_date", "subscribers", "seen", F.posexplode("seen").alias("place", "region1"))
    pairs = first.select(
        F.col("call_date").alias("connection_date"), "region1", "subscribers",
        F.explode(F.expr("slice(seen, place + 2, size(seen))")).alias("region2"))
    counts = pairs.groupBy("connection_date", "region1", "region2").agg(F.sum("subscribers").alias("subscriber_count"))
    return _published(counts, "subscriber_count", privacy)


def _directed(presence: DataFrame, block: int) -> DataFrame:
    """Regions `a`, `b` of a subscriber-day with the first visit to `a` before the last one to `b`.

    The regions of a subscriber-day are ordered by their first visit and cut into blocks; each pair of blocks is put together in a
    row of its own, so no row holds more than two blocks, however many regions there are. Nearly all have one block. Pairs
    of blocks in which every last visit comes too early are left out.
    """
    day = Window.partitionBy("msisdn", "call_date")
    ordered = day.orderBy("earliest", "region")
    placed = presence.where("region IS NOT NULL").withColumns({
        "_place": F.row_number().over(ordered) - 1, "_of": F.count(F.lit(1)).over(day)}).where("_of > 1")
    own, blocks = F.floor(F.col("_place") / block), F.ceil(F.col("_of") / block)
    others = F.sequence(F.lit(0).cast("bigint"), blocks - 1)
    here = F.struct("region", "earliest", "latest")
    nowhere = F.lit(None).cast("struct<region:string,earliest:timestamp,latest:timestamp>")
    from_here = F.transform(others, lambda j: F.struct(own.alias("i"), j.alias("j"), here.alias("a"), nowhere.alias("b")))
    to_here = F.transform(others, lambda i: F.struct(i.alias("i"), own.alias("j"), nowhere.alias("a"), here.alias("b")))
    alone = F.array(F.struct(own.alias("i"), own.alias("j"), here.alias("a"), here.alias("b")))
    units = placed.select(
        "msisdn", "call_date", F.inline(F.when(blocks == 1, alone).otherwise(F.concat(from_here, to_here))))
    rows = units.groupBy("msisdn", "call_date", "i", "j").agg(
        F.collect_list("a").alias("froms"), F.collect_list("b").alias("tos"),
        F.min(F.col("a")["earliest"]).alias("first"), F.max(F.col("b")["latest"]).alias("last")).where("first < last")
    starts = rows.select("msisdn", "call_date", "tos", F.explode("froms").alias("a"))
    return starts.select("msisdn", "call_date", "a", F.explode("tos").alias("b")).where(
        "a.region <> b.region AND a.earliest < b.latest")


def directed_region_pairs_per_day(presence: DataFrame, period: Period | None = None,
                                  privacy: Privacy | None = AT_LEAST_15, by_subscriber: bool = False,
                                  block: int = BLOCK) -> DataFrame:
    """Subscribers first seen in one region before they were last seen in the other, on a day."""
    pairs = _directed(_in(presence, period), block)
    counts = pairs.groupBy(
        F.col("call_date").alias("connection_date"), *(["msisdn"] if by_subscriber else []),
        F.col("a.region").alias("region_from"), F.col("b.region").alias("region_to"),
    ).agg(F.count(F.lit(1)).alias("subscriber_count"))
    return _published(counts, "subscriber_count", privacy)


def calls_per_region_per_day(presence: DataFrame, period: Period | None = None,
                             privacy: Privacy | None = AT_LEAST_15) -> DataFrame:
    """Visits per date and region, published by the number of subscribers behind them."""
    counts = _in(presence, period).groupBy("call_date", "region").agg(
        F.sum("visits").alias("total_calls"), F.count("msisdn").alias("subscriber_count")
    )
    return _published(counts, "subscriber_count", privacy).drop("subscriber_count")


def residents_per_region(homes: DataFrame, privacy: Privacy | None = AT_LEAST_15) -> DataFrame:
    counts = homes.groupBy("region").agg(F.count("msisdn").alias("subscriber_count"))
    return _published(counts, "subscriber_count", privacy)
