import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callgrain.operators.visits import mapped_visits, presence, visits
from callgrain.params import Period, Privacy
from callgrain.plans import regions
from conftest import START, as_set

DAY = date(2024, 1, 1)


@pytest.fixture
def cells(spark):
    return spark.createDataFrame(
        [("n1", "North"), ("n2", "North"), ("s1", "South"), ("e1", "East"), ("x1", None)], "cell_id string, region string"
    )


@pytest.fixture
def present(records, cells):
    """Presence of the callers; recipients have no antenna."""
    def make(*rows):
        return presence(mapped_visits(visits(records(*rows), min_id_length=1), cells))

    return make


def stay(who, where, at):
    return {"a": who, "from": where, "at": at}


def test_visits_of_both_sides(records):
    long = "s" * 20
    df = records({"a": long, "b": "short", "from": "n1", "to": "n2", "at": 0}, {"a": "short", "b": long, "to": "s1", "at": 5},
                 {"a": None, "b": long, "from": "n1", "to": "e1", "at": 6}, {"a": long, "b": None, "from": "x1", "at": 7})
    rows = visits(df).select("msisdn", "location_id", "event_id")
    assert as_set(rows) == {(long, "n1", 0), (long, "s1", 1), (long, "e1", 2), (long, "x1", 3)}


def test_home_is_where_days_end(present):
    rows = [stay("A", "n1", 0), stay("A", "s1", 3600), stay("A", "n1", 86400), stay("A", "s1", 90000),
            stay("A", "n1", 2 * 86400), stay("B", "s1", 0), stay("B", "n1", 86400),
            # C's only day ends in two regions at once; D sees only an unmapped cell.
            stay("C", "s1", 5), stay("C", "e1", 5), stay("D", "zz", 0)]
    homes = regions.home_locations(present(*rows))
    assert as_set(homes) == {("A", "South"), ("B", "North"), ("C", "East")}
    early = regions.home_locations(present(*rows), Period(date(2024, 1, 3), date(2024, 1, 9)))
    assert as_set(early) == {("A", "North")}


def test_threshold_keeps_exactly_its_count(present):
    table = present(*[stay(f"S{n}", "n1", n) for n in range(15)], *[stay(f"S{n}", "s1", n) for n in range(14)])
    assert as_set(regions.subscribers_per_region_per_day(table)) == {(DAY, "North", 15)}
    assert as_set(regions.subscribers_per_region_per_day(table, privacy=Privacy(15, strict=True))) == set()
    assert as_set(regions.subscribers_per_region_per_day(table, privacy=None)) == {(DAY, "North", 15), (DAY, "South", 14)}
    assert as_set(regions.calls_per_region_per_day(table)) == {(DAY, "North", 15)}


def test_subscribers_count_once(present):
    table = present(*[stay("A", cell, n) for n, cell in enumerate(["n1", "n2", "n1"])])
    assert as_set(regions.subscribers_per_region_per_day(table, privacy=None)) == {(DAY, "North", 1)}
    assert as_set(regions.calls_per_region_per_day(table, privacy=Privacy(1))) == {(DAY, "North", 3)}


def test_visitors_take_withheld_residents_as_none(present):
    table = present(*[stay(f"R{n}", "n1", n) for n in range(3)], *[stay(f"V{n}", "n1", n) for n in range(4)],
                    *[stay(f"V{n}", "s1", 3600 + n) for n in range(4)])
    homes = regions.home_locations(table)
    assert as_set(regions.residents_per_region(homes, None)) == {("North", 3), ("South", 4)}
    k = Privacy(4)
    assert as_set(regions.residents_per_region_per_day(table, homes, privacy=k)) == {(DAY, "South", 4)}
    assert as_set(regions.visitors_per_region_per_day(table, homes, privacy=k)) == {(DAY, "North", 7)}
    exact = regions.visitors_per_region_per_day(table, homes, privacy=k, threshold_inputs=False)
    assert as_set(exact) == {(DAY, "North", 4)}


def test_visitors_and_residents_add_up(present):
    table = present(*[stay(f"S{n % 9}", cell, 1000 * n) for n, cell in enumerate(["n1", "s1", "e1", "n2"] * 20)])
    homes = regions.home_locations(table)
    everyone, residents, guests = [
        {tuple(r)[:2]: r.subscriber_count for r in df.collect()} for df in (
            regions.subscribers_per_region_per_day(table, privacy=None),
            regions.residents_per_region_per_day(table, homes, privacy=None),
            regions.visitors_per_region_per_day(table, homes, privacy=None),
        )
    ]
    assert everyone == {key: residents.get(key, 0) + guests[key] for key in everyone}


def test_weeks(present):
    # The last days of 2024 belong to ISO week 1 of 2025.
    table = present(stay("A", "n1", 0), stay("A", "n1", 86400), stay("B", "n1", datetime(2024, 12, 31)))
    assert as_set(regions.subscribers_per_region_per_week(table, privacy=None)) == {(1, "North", 2)}
    apart = regions.subscribers_per_region_per_week(table, privacy=None, iso_year=True)
    assert as_set(apart) == {(2024, 1, "North", 1), (2025, 1, "North", 1)}
    homes = regions.home_locations(table)
    assert as_set(regions.visitors_per_region_per_week(table, homes, privacy=Privacy(0))) == {(1, "North", 0)}


def test_interleaved_regions_count_both_ways(present):
    table = present(stay("A", "n1", 0), stay("A", "s1", 60), stay("A", "n2", 120))
    assert as_set(regions.region_pairs_per_day(table, privacy=None)) == {(DAY, "North", "South", 1)}
    assert as_set(regions.directed_region_pairs_per_day(table, privacy=None)) == {
        (DAY, "North", "South", 1), (DAY, "South", "North", 1),
    }


def test_one_way(present):
    table = present(stay("A", "n1", 0), stay("A", "s1", 60), stay("B", "n1", 5), stay("B", "s1", 5),
                    stay("C", "x1", 0), stay("C", "n1", 9), stay("C", "s1", 86400))
    assert as_set(regions.directed_region_pairs_per_day(table, privacy=None)) == {(DAY, "North", "South", 1)}
    assert as_set(regions.region_pairs_per_day(table, privacy=None)) == {(DAY, "North", "South", 2)}
    per_subscriber = regions.directed_region_pairs_per_day(table, privacy=None, by_subscriber=True)
    assert as_set(per_subscriber) == {(DAY, "A", "North", "South", 1)}


def test_period_applies_to_dates(present):
    table = present(stay("A", "n1", 0), stay("A", "n1", 86400 * 3))
    period = Period(DAY + timedelta(days=1), DAY + timedelta(days=3))
    assert as_set(regions.subscribers_per_region_per_day(table, period, None)) == {(DAY + timedelta(days=3), "North", 1)}


def test_homes_by_windows_are_those_by_grouping(spark):
    import random

    pick = random.Random(4)
    rows = [(pick.choice("ABCDEF"), date(2024, 1, pick.randrange(1, 20)), pick.choice(["N", "S", "W", None])) for _ in range(300)]
    table = spark.createDataFrame(
        [(m, d, r, 1, datetime(d.year, d.month, d.day, 1), datetime(d.year, d.month, d.day, pick.randrange(2, 6)))
         for m, d, r in sorted(set(rows), key=repr)],
        "msisdn string, call_date date, region string, visits long, earliest timestamp, latest timestamp")
    for period in (None, Period(date(2024, 1, 3), date(2024, 1, 9)), Period(date(2023, 1, 1), date(2023, 1, 2))):
        marked = regions.with_homes(table, period)
        homes = regions.home_locations(table, period).where("region IS NOT NULL")
        assert as_set(regions.homes_of(marked).select("msisdn", "region")) == as_set(homes.select("msisdn", "region"))
        for result in (regions.residents_per_region_per_day, regions.residents_per_region_per_week,
                       regions.visitors_per_region_per_day, regions.visitors_per_region_per_week):
            assert as_set(result(marked, None, privacy=None)) == as_set(result(table, homes, privacy=None))


def test_residents_read_the_records_once(spark):
    from verification.catalog import queries

    for name in ("residents_per_region_per_day", "visitors_per_region_per_day", "residents_per_region_per_week",
                 "visitors_per_region_per_week"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [event_id") == 1, plan


def test_equal_region_sets_are_paired_once(spark):
    """Before pairs are made there is one row for each set of regions of a day."""
    rows = [(f"s{k}", date(2024, 1, 1 + k % 2), region, 1, START, START) for k in range(60)
            for region in (("A", "B", "C") if k % 3 else ("B", "D"))]
    rows += [("alone", date(2024, 1, 1), "A", 1, START, START), ("none", date(2024, 1, 1), None, 1, START, START)]
    seen = spark.createDataFrame(rows, "msisdn string, call_date date, region string, visits long, earliest timestamp, latest timestamp")
    sets = regions.region_sets(seen).collect()
    assert sorted((r.call_date.day, tuple(r.seen), r.subscribers) for r in sets) == [
        (d, s, n) for d in (1, 2) for s, n in ((("A", "B", "C"), 20), (("B", "D"), 10))]
    pairs = {(r.connection_date.day, r.region1, r.region2): r.subscriber_count for r in regions.region_pairs_per_day(seen, privacy=None).collect()}
    assert pairs == {(d, a, b): n for d in (1, 2) for a, b, n in (("A", "B", 20), ("A", "C", 20), ("B", "C", 20), ("B", "D", 10))}


@pytest.mark.parametrize("block", [1, 3, 7, 256])
def test_blocks_do_not_change_directed_pairs(spark, block):
    rng = random.Random(8)
    rows = []
    for k in range(12):
        for region in range(rng.randrange(1, 15)):
            first = rng.randrange(1000)
            rows.append((f"s{k}", date(2024, 1, 1 + k % 2), f"r{region}", 1, START + timedelta(seconds=first),
                         START + timedelta(seconds=first + rng.choice([0, 5, 300]))))
    seen = spark.createDataFrame(rows, "msisdn string, call_date date, region string, visits long, earliest timestamp, latest timestamp")
    expected = Counter((a[1], a[2], b[2]) for a in rows for b in rows
                       if a[:2] == b[:2] and a[2] != b[2] and a[4] < b[5])
    found = regions.directed_region_pairs_per_day(seen, privacy=None, block=block).collect()
    assert {(r.connection_date, r.region_from, r.region_to): r.subscriber_count for r in found} == expected


def test_a_day_in_5000_regions(spark):
    """Every region is seen for one second, one after the other: a pair for each two of them, and no row with all of them."""
    n = 5000
    seen = spark.range(n).select(
        F.lit("s").alias("msisdn"), F.lit(date(2024, 1, 1)).alias("call_date"), F.format_string("r%05d", "id").alias("region"),
        F.lit(1).alias("visits"), F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("earliest"),
        F.timestamp_seconds(F.col("id") + 1_704_067_200).alias("latest"))
    pairs = regions.directed_region_pairs_per_day(seen, privacy=None)
    row = pairs.agg(F.count("*"), F.count_if(F.expr("region_from < region_to")), F.max("subscriber_count")).first()
    assert tuple(row) == (n * (n - 1) // 2, n * (n - 1) // 2, 1)
