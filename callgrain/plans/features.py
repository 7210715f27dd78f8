"""The twenty subscriber features.

Each function gives a feature in long form: `caller_id`, its categories, then `value`, or the seven
statistics. `FEATURES` lists them with what is needed to lay them out in one row per caller.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window, functions as F

from callgrain.functions.geo import great_circle_km
from callgrain.functions.stats import FIXED, shannon_entropy, steady_sum
from callgrain.operators.categories import FINE_CELLS, explode_cells, widen
from callgrain.operators.conversations import conversation_openings, tag_pairs
from callgrain.operators.gaps import gaps_between_interactions
from callgrain.operators.grains import (
    active_day_cells, activity_cells, antenna_cells, antenna_sums, contact_cells, contact_counts, contact_sums,
)
from callgrain.operators.interactions import both_sides, directed_interactions, pair_interactions
from callgrain.operators.pareto import pareto_head
from callgrain.operators.value_counts import cells_of_counts, counted_stats, value_counts
from callgrain.params import ALL_DAY, CALL, STATS, TEXT, FeatureParams
from callgrain.sources.runs import Run

WEEK_DAY = ["weekday", "daytime"]
CALLER_CELL = ["caller_id", *WEEK_DAY]
TYPED_CELL = [*CALLER_CELL, "txn_type"]


@dataclass
class FeatureInputs:
    """Cleaned records and antenna coordinates, and the tables that several features share."""

    cdr: DataFrame
    antennas: DataFrame
    params: FeatureParams
    is_laid_out: bool = False

    @cached_property
    def directed(self) -> DataFrame:
        return directed_interactions(self.cdr, self.params.calendar)

    @cached_property
    def records(self) -> int:
        return self.cdr.count()

    @cached_property
    def contact_sums(self) -> DataFrame:
        return contact_sums(self.cdr, self.params.calendar)

    @cached_property
    def contacts(self) -> DataFrame:
        return contact_cells(self.contact_sums)

    @cached_property
    def tagged(self) -> DataFrame:
        pairs = pair_interactions(self.cdr, self.params.calendar)
        return tag_pairs(pairs, self.params.max_wait, self.params.split, total=2 * self.records)

    # Tables by caller. Each has a limited number of rows for one caller, however many records there are.

    @cached_property
    def activity(self) -> DataFrame:
        return activity_cells(self.directed)

    @cached_property
    def days(self) -> DataFrame:
        return active_day_cells(self.directed)

    @cached_property
    def antenna_use(self) -> DataFrame:
        return antenna_sums(self.cdr, self.params.calendar)

    @cached_property
    def contact_counts(self) -> DataFrame:
        """Per caller, type and cell: `contacts`, the number of those with `n_out` and `n_in` interactions."""
        return contact_counts(self.contacts)

    @cached_property
    def call_heads(self) -> DataFrame:
        """Per caller and cell: `head` and `items` of the contacts by call seconds."""
        calls = self.contacts.where(F.col("txn_type") == CALL)
        # Each cell has at most one contact per record and side.
        most = 18 * self.records
        return pareto_head(calls, CALLER_CELL, "seconds", self.params.pareto_share, self.params.split, most)

    @cached_property
    def openings(self) -> DataFrame:
        return conversation_openings(self.tagged, self.params.calendar)

    @cached_property
    def durations(self) -> DataFrame:
        """Counts of the durations of calls."""
        return value_counts(self.directed.where(F.col("txn_type") == CALL), ["caller_id", "txn_type"], "duration")

    @cached_property
    def delays(self) -> DataFrame:
        """Counts of the seconds to a reply; texts that are none count as null."""
        texts = both_sides(self.tagged.where(F.col("txn_type") == TEXT))
        replies = (F.col("direction") == "out") & F.col("answers")
        return value_counts(texts.withColumn("delay", F.when(replies, F.col("wait"))), ["caller_id"], "delay")

    @cached_property
    def gaps(self) -> DataFrame:
        """Counts `n` of the seconds (`wait`) between interactions, per type and cell."""
        gaps = gaps_between_interactions(self.directed, self.params.split, total=2 * self.records)
        return gaps.groupBy(*TYPED_CELL, "wait").agg(F.count(F.lit(1)).alias("n"))

    def laid_out(self, run: Run, buckets: int) -> FeatureInputs:
        """The same inputs with the tables by caller written once, in buckets of callers: features then need no exchange.

        The two tables that several of these come from are written as they are; they are not by caller.
        """
        base = FeatureInputs(self.cdr, self.antennas, self.params)
        base.contact_sums = run.shared("contact_sums", lambda: self.contact_sums)
        base.tagged = run.shared("texts", lambda: self.tagged.where(F.col("txn_type") == TEXT).select(
            "lo", "hi", "lo_sent", "timestamp", "txn_type", "weekday", "daytime", "wait", "conversation", "answers"))
        out = FeatureInputs(self.cdr, self.antennas, self.params, is_laid_out=True)
        for name in BY_CALLER:
            setattr(out, name, run.shared(name, lambda name=name: getattr(base, name), "caller_id", buckets))
        return out

    def by_caller(self, table: DataFrame) -> DataFrame:
        """A table by caller with all rows of a caller in one place: as laid out, else after one exchange of its few rows."""
        return table if self.is_laid_out else table.repartition("caller_id")

    @property
    def weighted_contacts(self) -> DataFrame:
        """`contact_counts`, or single contacts where counting them first would only be a further exchange."""
        return self.contact_counts if self.is_laid_out else self.contacts.withColumn("contacts", F.lit(1))


#: Properties of FeatureInputs that a job lays out by caller.
BY_CALLER = ("activity", "days", "antenna_use", "contact_counts", "call_heads", "openings", "durations", "delays", "gaps")


def active_days(inputs: FeatureInputs) -> DataFrame:
    return inputs.days.withColumnRenamed("days", "value")


def number_of_contacts(inputs: FeatureInputs) -> DataFrame:
    return inputs.weighted_contacts.groupBy(*TYPED_CELL).agg(F.sum("contacts").alias("value"))


def call_duration(inputs: FeatureInputs) -> DataFrame:
    counted = cells_of_counts(inputs.by_caller(inputs.durations), ["caller_id", "txn_type"], "duration")
    return counted_stats(counted, TYPED_CELL, "duration")


def percent_nocturnal(inputs: FeatureInputs) -> DataFrame:
    n = F.col("n_out") + F.col("n_in")
    at_night = F.sum(F.when(F.col("daytime") == "night", n).otherwise(0))
    fine = inputs.activity.where(F.col("daytime") != ALL_DAY)
    return fine.groupBy("caller_id", "weekday", "txn_type").agg((at_night / F.sum(n)).alias("value"))


def percent_initiated_conversations(inputs: FeatureInputs) -> DataFrame:
    return inputs.openings.select(*CALLER_CELL, (F.col("sent") / (F.col("sent") + F.col("received"))).alias("value"))


def percent_initiated_interactions(inputs: FeatureInputs) -> DataFrame:
    calls = inputs.activity.where(F.col("txn_type") == CALL)
    return calls.select(*CALLER_CELL, (F.col("n_out") / (F.col("n_out") + F.col("n_in"))).alias("value"))


def response_delay_text(inputs: FeatureInputs) -> DataFrame:
    counted = cells_of_counts(inputs.by_caller(inputs.delays), ["caller_id"], "delay")
    return counted_stats(counted, CALLER_CELL, "delay")


def response_rate_text(inputs: FeatureInputs) -> DataFrame:
    received = inputs.openings.where(F.col("received") > 0)
    return received.select(*CALLER_CELL, (F.col("answered") / F.col("received")).alias("value"))


def entropy_of_contacts(inputs: FeatureInputs) -> DataFrame:
    entropy = shannon_entropy(F.col("n_out") + F.col("n_in"), "contacts")
    return inputs.weighted_contacts.groupBy(*TYPED_CELL).agg(entropy.alias("value"))


def _contacts_with(inputs: FeatureInputs, value: Column, name: str) -> DataFrame:
    """Per caller, type, cell and value: the number of `contacts` that have it."""
    return inputs.by_caller(inputs.contact_counts).groupBy(*TYPED_CELL, value.alias(name)).agg(
        F.sum("contacts").alias("contacts"))


def balance_of_contacts(inputs: FeatureInputs) -> DataFrame:
    share = F.col("n_out") / (F.col("n_out") + F.col("n_in"))
    counted = _contacts_with(inputs, share, "balance")
    return counted_stats(counted, TYPED_CELL, "balance", "contacts", exact=False)


def interactions_per_contact(inputs: FeatureInputs) -> DataFrame:
    counted = _contacts_with(inputs, F.col("n_out") + F.col("n_in"), "n")
    return counted_stats(counted, TYPED_CELL, "n", "contacts")


def interevent_time(inputs: FeatureInputs) -> DataFrame:
    return counted_stats(inputs.gaps, TYPED_CELL, "wait")


def percent_pareto_interactions(inputs: FeatureInputs) -> DataFrame:
    contacts = inputs.weighted_contacts.withColumn("n", F.col("n_out") + F.col("n_in"))
    heads = pareto_head(contacts, TYPED_CELL, "n", inputs.params.pareto_share, times="contacts")
    return heads.select(*TYPED_CELL, (F.col("head") / F.col("items")).alias("value"))


def percent_pareto_durations(inputs: FeatureInputs) -> DataFrame:
    return inputs.call_heads.select(*CALLER_CELL, (F.col("head") / F.col("items")).alias("value"))


def number_of_interactions(inputs: FeatureInputs) -> DataFrame:
    directions = ", ".join(
        f"struct('{name}' AS direction, {count} AS value)"
        for name, count in (("in", "n_in"), ("out", "n_out"), ("alldir", "n_in + n_out"))
    )
    return inputs.activity.selectExpr(*TYPED_CELL, f"inline(array({directions}))").where("value > 0")


def number_of_antennas(inputs: FeatureInputs) -> DataFrame:
    return antenna_cells(inputs.antenna_use).groupBy(*CALLER_CELL).agg(F.count("caller_antenna").alias("value"))


def entropy_of_antennas(inputs: FeatureInputs) -> DataFrame:
    return antenna_cells(inputs.antenna_use).groupBy(*CALLER_CELL).agg(shannon_entropy("n").alias("value"))


def percent_at_home(inputs: FeatureInputs) -> DataFrame:
    """Home is the antenna with the most night interactions, the smallest id among equals."""
    known = inputs.antenna_use.where("caller_antenna IS NOT NULL").withColumn(
        "nights", F.col("n_weekday_night") + F.col("n_weekend_night")
    )
    # A caller has at most one row per antenna here, so the window holds no more than the antennas.
    rank = F.when(F.col("nights") > 0, F.struct((-F.col("nights")).alias("order"), "caller_antenna"))
    homes = F.min(rank).over(Window.partitionBy("caller_id"))["caller_antenna"]
    placed = known.withColumn("home", homes).where(F.col("home").isNotNull())
    sums = [F.sum(f"n_{w}_{d}").alias(f"n_{w}_{d}") for w, d in FINE_CELLS]
    at_home = [
        F.sum(F.when(F.col("caller_antenna") == F.col("home"), F.col(f"n_{w}_{d}")).otherwise(0)).alias(f"home_{w}_{d}")
        for w, d in FINE_CELLS
    ]
    cells = explode_cells(placed.groupBy("caller_id").agg(*sums, *at_home), ["caller_id"], ["n", "home"], present=["n"])
    return cells.select(*CALLER_CELL, (F.col("home") / F.col("n")).alias("value"))


def radius_of_gyration(inputs: FeatureInputs) -> DataFrame:
    """Root mean square distance of interactions from their mean coordinates, in km."""
    located = inputs.antennas.where("antenna_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")
    used = inputs.antenna_use.join(located, F.col("caller_antenna") == F.col("antenna_id"))
    sums = [f"n_{w}_{d}" for w, d in FINE_CELLS]
    cells = explode_cells(
        used.select("caller_id", "latitude", "longitude", *sums), ["caller_id", "latitude", "longitude"], ["n"], ["n"]
    )
    # One row per antenna and cell, weighted by its interactions.
    cell = Window.partitionBy(*CALLER_CELL)
    n = F.col("n")
    total = F.sum(n).over(cell)
    centred = cells.withColumns({
        "bar_lat": F.sum((F.col("latitude") * n).cast(FIXED)).over(cell).cast("double") / total,
        "bar_lon": F.sum((F.col("longitude") * n).cast(FIXED)).over(cell).cast("double") / total,
    })
    km = great_circle_km(F.col("latitude"), F.col("longitude"), F.col("bar_lat"), F.col("bar_lon"))
    return (
        centred.withColumn("square", km * km).groupBy(*CALLER_CELL)
        .agg(F.sqrt(steady_sum(F.col("square") * n) / F.sum(n)).alias("value"))
    )


def frequent_antennas(inputs: FeatureInputs) -> DataFrame:
    heads = pareto_head(antenna_cells(inputs.antenna_use), CALLER_CELL, "n", inputs.params.pareto_share)
    return heads.select(*CALLER_CELL, F.col("head").alias("value"))


@dataclass(frozen=True)
class Feature:
    name: str
    compute: Callable[[FeatureInputs], DataFrame]
    categories: tuple[str, ...]
    values: tuple[str, ...] = ("value",)

    def long(self, inputs: FeatureInputs) -> DataFrame:
        return self.compute(inputs).select("caller_id", *self.categories, *self.values)

    def wide(self, inputs: FeatureInputs) -> DataFrame:
        return self.layout(self.compute(inputs), inputs.params)

    def layout(self, long: DataFrame, params: FeatureParams) -> DataFrame:
        """One row per caller from the long form."""
        types = params.txn_types if self.name != "call_duration" else (CALL,)
        return widen(long, self.name, list(self.categories), list(self.values), types)


CELL = ("weekday", "daytime")
TYPED = (*CELL, "txn_type")

FEATURES = {
    feature.name: feature
    for feature in (
        Feature("active_days", active_days, CELL),
        Feature("number_of_contacts", number_of_contacts, TYPED),
        Feature("call_duration", call_duration, TYPED, STATS),
        Feature("percent_nocturnal", percent_nocturnal, ("weekday", "txn_type")),
        Feature("percent_initiated_conversations", percent_initiated_conversations, CELL),
        Feature("percent_initiated_interactions", percent_initiated_interactions, CELL),
        Feature("response_delay_text", response_delay_text, CELL, STATS),
        Feature("response_rate_text", response_rate_text, CELL),
        Feature("entropy_of_contacts", entropy_of_contacts, TYPED),
        Feature("balance_of_contacts", balance_of_contacts, TYPED, STATS),
        Feature("interactions_per_contact", interactions_per_contact, TYPED, STATS),
        Feature("interevent_time", interevent_time, TYPED, STATS),
        Feature("percent_pareto_interactions", percent_pareto_interactions, TYPED),
        Feature("percent_pareto_durations", percent_pareto_durations, CELL),
        Feature("number_of_interactions", number_of_interactions, ("direction", *TYPED)),
        Feature("number_of_antennas", number_of_antennas, CELL),
        Feature("entropy_of_antennas", entropy_of_antennas, CELL),
        Feature("frequent_antennas", frequent_antennas, CELL),
        Feature("percent_at_home", percent_at_home, CELL),
        Feature("radius_of_gyration", radius_of_gyration, CELL),
    )
}
