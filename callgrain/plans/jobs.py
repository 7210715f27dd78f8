"""The jobs: all subscriber features, all mobility indicators, all regional aggregates, written to a folder."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache, reduce

from pyspark.sql import DataFrame, functions as F

from callgrain.operators.visits import (
    mapped_visits, presence, presence_of_hours, presence_per_hour, regional_visits, visits,
)
from callgrain.params import AT_LEAST_15, MORE_THAN_15, FeatureParams, Period, Privacy
from callgrain.plans import regions
from callgrain.plans.features import FEATURES, FeatureInputs
from callgrain.plans.indicators import (
    home_region_counts, home_regions, origin_destination, transactions, unique_subscribers, unique_subscribers_country,
)
from callgrain.sources.cdr import join_on
from callgrain.sources.runs import Run

#: Name of the table of all features side by side.
ALL_FEATURES = "all_features"


def write_features(cdr: DataFrame, antennas: DataFrame, folder: str, params: FeatureParams | None = None,
                   names: Iterable[str] | None = None, wide: bool = True, table: bool = False,
                   buckets: int | None = None) -> dict[str, str]:
    """Write each feature to its own directory, in one row per caller or in long form; with `table` also all of them side by side.

    The tables that features come from are written once first, laid out in `buckets` of callers (by default as many as there
    are shuffle partitions), and so are the features: these need no exchange then. Results are Parquet folders like any other;
    `runs.register_laid_out` makes their layout known again. A job that stopped can be called again: see `sources.runs`.
    """
    params = params or FeatureParams()
    features = [FEATURES[name] for name in (names or FEATURES)]
    buckets = buckets or int(cdr.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    arguments = (params, wide, sorted(f.name for f in features), table, buckets)
    with Run(folder, [cdr, antennas], arguments) as run:
        if not all(run.has(f.name) for f in features):
            inputs = FeatureInputs(cdr, antennas, params).laid_out(run, buckets)
            for f in features:
                run.publish(f.name, lambda f=f: f.wide(inputs) if wide else f.long(inputs), "caller_id", buckets)
        paths = {f.name: f"{run.folder}/{f.name}" for f in features}
        if table:
            paths[ALL_FEATURES] = run.publish(
                ALL_FEATURES, lambda: feature_table([run.result(f.name) for f in features]), "caller_id", buckets)
        run.finish()
    return paths


def feature_table(features: list[DataFrame]) -> DataFrame:
    """All features of a caller in one row, from wide tables.

    All callers come first, and tables are joined to them from the left: that keeps the layout by caller, so each table
    is shuffled once, and not at all if it is laid out (then only the callers' ids are), and the growing row never is.
    """
    # As new values: a union of laid-out tables counts as laid out itself, and would then keep an id once for each table.
    ids = [df.select(F.concat("caller_id", F.lit("")).alias("caller_id")) for df in features]
    callers = reduce(DataFrame.union, ids).distinct()
    return join_on([callers, *features], "caller_id", "left")


def write_mobility(cdr: DataFrame, cells: DataFrame, folder: str, period: Period, as_of: Period | None = None,
                   by_subscriber: bool = False, *, min_id_length: int = 20, cutoff_days: int = 7,
                   publish: Privacy | None = MORE_THAN_15, within: Privacy | None = AT_LEAST_15,
                   visits_per: str = "hour", country_per: str = "day", homes_per: str = "month",
                   subscriber_homes_per: str = "day") -> dict[str, str]:
    """Write the mobility indicators: thresholded counts, or subscriber-level rows beside thresholded counts of homes.

    `as_of` is the period of the connections within days; by default the same. Only records of the two periods are read.
    Presence by hour and by day is stored once, laid out by subscriber, and all tables follow from it: what is grouped by
    subscriber needs no exchange of its own. A job that stopped can be called again.
    """
    with Run(folder, [cdr, cells], (
        period, as_of, by_subscriber, min_id_length, cutoff_days, publish, within, visits_per, country_per, homes_per,
        subscriber_homes_per)) as run:
        records = period.union(as_of).prune(cdr)
        located = regional_visits(visits(records, min_id_length), cells)
        # A subscriber has a limited number of rows: at most one for each region and hour of the periods.
        buckets = int(cdr.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        hours = cache(lambda: run.shared("presence_per_hour", lambda: presence_per_hour(located), "msisdn", buckets))
        days = cache(lambda: run.shared("presence", lambda: presence_of_hours(hours()), "msisdn", buckets))
        homes_publish = publish
        if by_subscriber:
            publish, within = None, None
        tables = {
            f"transactions_per_{visits_per}": lambda: transactions(hours(), period, visits_per, publish, by_subscriber),
            f"unique_subscribers_country_per_{country_per}":
                lambda: unique_subscribers_country(hours(), period, country_per, publish),
            "origin_destination_per_day": lambda: origin_destination(
                days(), period, "day", as_of, within, publish, cutoff_days, by_subscriber
            ),
            f"home_regions_per_{homes_per}": lambda: home_region_counts(hours(), period, homes_per, homes_publish),
            f"unique_subscribers_per_{visits_per}": lambda: unique_subscribers(hours(), period, visits_per, publish),
        }
        if by_subscriber:
            tables[f"subscriber_home_regions_per_{subscriber_homes_per}"] = lambda: home_regions(hours(), period, subscriber_homes_per)
        return run.publish_all(tables)


def write_regions(cdr: DataFrame, cells: DataFrame, folder: str, period: Period, as_of: Period | None = None, *,
                  min_id_length: int = 20, privacy: Privacy | None = AT_LEAST_15, threshold_inputs: bool = True,
                  iso_year: bool = False) -> dict[str, str]:
    """Write the regional aggregates. Homes are those of `period`; daily tables cover `as_of` (by default the same), weekly
    ones the full weeks of `period`. Presence, marked with homes, is stored once."""
    as_of, weeks = as_of or period, period.full_weeks()
    records = period.union(as_of).prune(cdr)
    with Run(folder, [cdr, cells], (period, as_of, min_id_length, privacy, threshold_inputs, iso_year)) as run:
        seen = cache(lambda: run.shared("presence", lambda: regions.with_homes(
            presence(mapped_visits(visits(records, min_id_length), cells)), period)))
        tables = {
            "subscribers_per_region_per_day": lambda: regions.subscribers_per_region_per_day(seen(), as_of, privacy),
            "subscribers_per_region_per_week": lambda: regions.subscribers_per_region_per_week(seen(), weeks, privacy, iso_year),
            "home_locations": lambda: regions.homes_of(seen()),
            "residents_per_region": lambda: regions.residents_per_region(regions.homes_of(seen()), privacy),
            "residents_per_region_per_day": lambda: regions.residents_per_region_per_day(seen(), None, as_of, privacy),
            "residents_per_region_per_week": lambda: regions.residents_per_region_per_week(seen(), None, weeks, privacy, iso_year),
            "visitors_per_region_per_day": lambda: regions.visitors_per_region_per_day(seen(), None, as_of, privacy, threshold_inputs),
            "visitors_per_region_per_week": lambda: regions.visitors_per_region_per_week(
                seen(), None, weeks, privacy, threshold_inputs, iso_year),
            "region_pairs_per_day": lambda: regions.region_pairs_per_day(seen(), as_of, privacy),
            "directed_region_pairs_per_day": lambda: regions.directed_region_pairs_per_day(seen(), as_of, privacy),
            "calls_per_region_per_day": lambda: regions.calls_per_region_per_day(seen(), as_of, privacy),
        }
        return run.publish_all(tables)
