from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from callgrain.operators.numbering import numbered
from callgrain.operators.visits import presence, presence_per_hour, regional_visits, visits
from callgrain.params import FREQUENCIES, GroupSplit, Period, Privacy
from callgrain.plans import indicators
from callgrain.plans.indicators import (
    subscriber_bitmaps, unique_from_bitmaps, unique_subscribers, unique_subscribers_country,
)
from conftest import as_set

PERIOD = Period(date(2024, 1, 1), date(2024, 1, 30))
DAY = 86400


@pytest.fixture
def located(spark, records):
    cells = spark.createDataFrame([("n", "North"), ("s", "South"), ("e", "East"), ("x", None)], "cell_id string, region string")

    def make(*stays):
        rows = [{"a": who, "from": where, "at": at} for who, where, at in stays]
        return regional_visits(visits(records(*rows), min_id_length=1), cells)

    return make


def moves(df):
    table = indicators.moves_between_days(presence(df), PERIOD)
    return sorted((r.msisdn, r.connection_date.day, r.region_from, r.region_to) for r in table.collect())


def test_gap_of_seven_days_and_a_second(located):
    assert moves(located(("A", "n", 0), ("A", "s", 7 * DAY))) == [("A", 8, "North", "South")]
    assert moves(located(("A", "n", 0), ("A", "s", 7 * DAY + 1))) == []


def test_moves_join_last_and_first_visits(located):
    stays = [("A", "n", 0), ("A", "s", 10), ("A", "s", DAY), ("A", "e", DAY + 5), ("A", "zz", 2 * DAY), ("A", "x", 3 * DAY)]
    # South to South is no move; unmapped cells are a region of their own, with or without a map entry.
    assert moves(located(*stays)) == [("A", 3, "East", "99999")]


def test_midnight_after_the_period_is_out(located):
    df = located(("A", "n", datetime(2024, 1, 30, 23, 59, 59)), ("A", "n", datetime(2024, 1, 31)))
    assert as_set(indicators.transactions(df, PERIOD, "month", None)) == {(datetime(2024, 1, 1), "North", 1)}


def test_counts_per_bucket(located):
    df = located(("A", "n", 0), ("A", "n", 60), ("B", "n", 90), ("A", "s", 7200), ("B", "zz", 7200))
    ten, noon, day = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12), datetime(2024, 1, 1)
    assert as_set(indicators.transactions(df, PERIOD, "hour", None)) == {
        (ten, "North", 3), (noon, "South", 1), (noon, "99999", 1)}
    assert as_set(indicators.transactions(df, PERIOD, "hour", Privacy(2, strict=True))) == {(ten, "North", 3)}
    assert as_set(indicators.transactions(df, PERIOD, "hour", None, by_subscriber=True)) >= {(ten, "North", "A", 2)}
    assert as_set(indicators.unique_subscribers(df, PERIOD, "day", None)) == {
        (day, "North", 2), (day, "South", 1), (day, "99999", 1)}
    assert as_set(indicators.unique_subscribers_country(df, PERIOD, "day", None)) == {(day, 2)}
    assert as_set(indicators.unique_subscribers_country(df, PERIOD, "day", Privacy(2, strict=True))) == set()


def test_home_region_counts_every_visit_of_the_last_second(located):
    # Day 1 ends with two visits in North at once, days 2 and 3 with one in South: a tie, South is later.
    stays = [("A", "n", 100), ("A", "n", 100), ("A", "s", DAY), ("A", "s", 2 * DAY)]
    assert as_set(indicators.home_regions(located(*stays), PERIOD, "month")) == {("A", datetime(2024, 1, 1), "South")}
    stays = stays[:3]
    assert as_set(indicators.home_regions(located(*stays), PERIOD, "month")) == {("A", datetime(2024, 1, 1), "North")}
    assert len(as_set(indicators.home_regions(located(*stays), PERIOD, "day"))) == 2


def test_home_region_of_an_hour_without_day_end(located):
    df = located(("A", "n", 0), ("A", "s", 30), ("A", "e", 7200))
    assert as_set(indicators.home_regions(df, PERIOD, "hour")) == {
        ("A", datetime(2024, 1, 1, 10), "South"), ("A", datetime(2024, 1, 1, 12), "East")}


def test_home_region_counts_threshold(located):
    df = located(*[(f"S{n}", "n", n) for n in range(16)], *[(f"T{n}", "s", n) for n in range(15)])
    assert as_set(indicators.home_region_counts(df, PERIOD, "month")) == {(datetime(2024, 1, 1), "North", 16)}


def test_matrix_adds_both_kinds(located):
    df = located(("A", "n", 0), ("A", "s", 60), ("B", "n", 0), ("B", "s", DAY), ("C", "n", DAY), ("C", "s", DAY + 60),
                 ("C", "e", 2 * DAY), ("D", "zz", 0), ("D", "n", 60), ("D", "zz", DAY))
    matrix = indicators.origin_destination(presence(df), PERIOD, within=None, between=None)
    assert as_set(matrix) == {
        (date(2024, 1, 1), "North", "South", 1, 0, 1), (date(2024, 1, 2), "North", "South", 1, 1, 2),
        (date(2024, 1, 3), "South", "East", 0, 1, 1), (date(2024, 1, 2), "North", "99999", 0, 1, 1),
    }
    own = indicators.origin_destination(presence(df), PERIOD, within=None, between=None, by_subscriber=True)
    assert (date(2024, 1, 2), "B", "North", "South", 0, 1, 1) in as_set(own)
    assert own.columns.count("msisdn") == 1
    with pytest.raises(ValueError):
        indicators.origin_destination(presence(df), PERIOD, "week")


def test_enriched_visits(spark, located):
    df = located(("A", "n", 0), ("A", "zz", 60), ("A", "s", 120), ("B", "n", 5))
    homes = spark.createDataFrame([("A", "North")], "msisdn string, region string")
    filled = {(r.msisdn, r.region): r for r in indicators.enriched_visits(df, homes, GroupSplit()).collect()}
    assert (filled["A", "North"].region_lag, filled["A", "North"].region_lead) == ("99999", "99999")
    table = indicators.enriched_visits(df, homes, GroupSplit(), fill_ends=False)
    rows = {(r.msisdn, r.region): r for r in table.collect()}
    assert (rows["A", "North"].region_lag, rows["A", "North"].region_lead) == (None, "99999")
    assert (rows["A", "South"].region_lag, rows["A", "South"].region_lead) == ("99999", None)
    assert rows["A", "South"].call_datetime_lag == datetime(2024, 1, 1, 10, 1)
    assert (rows["A", "South"].home_region, rows["B", "North"].home_region) == ("North", None)
    assert (rows["A", "South"].hour_of_day, rows["A", "South"].constant) == (10, 1)
    assert dict(table.dtypes)["hour_of_day"] == "tinyint"
    assert set(FREQUENCIES) <= set(table.columns)


def test_distinct_subscribers_from_bitmaps(spark, records):
    """All frequencies from one table of bitmaps, also over more than one bitmap's worth of subscribers."""
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    rows = [{"a": f"a{n % 37}", "b": f"b{n % 11}", "from": "123"[n % 3], "to": "2" if n % 5 else None, "at": 7000 * n} for n in range(300)]
    located = regional_visits(visits(records(*rows), 1), cells)
    period = Period(date(2024, 1, 2), date(2024, 1, 20))
    maps = subscriber_bitmaps(presence_per_hour(located))
    for frequency in ("hour", "day", "week", "month"):
        for by_region, direct in ((True, unique_subscribers), (False, unique_subscribers_country)):
            found = unique_from_bitmaps(maps, period, frequency, None, by_region)
            assert as_set(found) == as_set(direct(located, period, frequency, None)), (frequency, by_region)
    many = spark.range(100_000).select(
        F.concat(F.lit("s"), "id").alias("msisdn"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 2 * 3600).alias("hour"),
        F.when(F.col("id") % 3 == 0, "N").otherwise("S").alias("region"))
    maps = subscriber_bitmaps(many)
    assert maps.agg(F.countDistinct("part")).first()[0] == 4
    assert {r["count"] for r in unique_from_bitmaps(maps, Period(date(2024, 1, 1), date(2024, 1, 1)), "day", None, False).collect()} == {100_000}
    numbers = numbered(many, "msisdn").agg(F.min("number"), F.max("number"), F.countDistinct("number")).first()
    assert tuple(numbers) == (0, 99_999, 100_000)
    assert unique_from_bitmaps(subscriber_bitmaps(many.where("false")), period, "day", None).count() == 0
