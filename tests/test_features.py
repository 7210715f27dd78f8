import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callgrain.operators.categories import VOCABULARY, group_with_totals
from callgrain.operators.interactions import directed_interactions
from callgrain.operators.pareto import pareto_head
from callgrain.params import Calendar, STATS
from callgrain.plans.features import FEATURES
from conftest import as_set, cell

NIGHT = datetime(2024, 1, 1, 22, 0, 0)


def calls(*contacts):
    """One call to a contact per letter."""
    return [{"at": 60 * n, "b": b} for n, b in enumerate("".join(contacts))]


def test_single_interaction(inputs):
    got = inputs({"at": 0, "duration": 30.0})
    row = cell(FEATURES["call_duration"].long(got), txn_type="call")
    assert (row["mean"], row["std"], row["median"], row["skewness"], row["kurtosis"], row["min"], row["max"]) == (
        30.0, 0.0, 30.0, None, None, 30.0, 30.0)
    assert cell(FEATURES["interevent_time"].long(got), txn_type="call")["mean"] is None
    assert cell(FEATURES["entropy_of_contacts"].long(got), txn_type="call").value == 0.0
    assert math.copysign(1, cell(FEATURES["entropy_of_contacts"].long(got), txn_type="call").value) == 1.0


def test_no_antennas(inputs):
    got = inputs({"at": 0}, {"at": 5})
    assert cell(FEATURES["entropy_of_antennas"].long(got)).value == 0.0
    assert cell(FEATURES["number_of_antennas"].long(got)).value == 0
    assert cell(FEATURES["frequent_antennas"].long(got)).value == 1
    assert FEATURES["percent_at_home"].long(got).count() == 0
    assert FEATURES["radius_of_gyration"].long(got).count() == 0


def test_pareto_at_exactly_the_share(inputs):
    got = inputs(*calls("B" * 8, "C", "D"))
    assert cell(FEATURES["percent_pareto_interactions"].long(got), txn_type="call").value == pytest.approx(1 / 3)
    got = inputs(*calls("B" * 7, "CC", "D"))
    assert cell(FEATURES["percent_pareto_interactions"].long(got), txn_type="call").value == pytest.approx(2 / 3)


def test_pareto_durations(inputs):
    rows = [{"at": n, "b": b, "duration": d} for n, (b, d) in enumerate([("B", 8.0), ("C", 1.0), ("D", 1.0), ("E", None)])]
    assert cell(FEATURES["percent_pareto_durations"].long(inputs(*rows))).value == 0.25
    silent = inputs({"at": 0, "duration": 0.0}, {"at": 1, "b": "C", "duration": 0.0})
    assert cell(FEATURES["percent_pareto_durations"].long(silent)).value is None


@pytest.mark.parametrize("share", [0.1, 0.5, 0.8, 0.95, 1.0])
def test_pareto_head_against_counting(spark, share):
    import random

    random.seed(7)
    groups = {g: [random.randint(1, 12) for _ in range(random.randint(1, 60))] for g in range(40)}
    items = spark.createDataFrame([(g, n) for g, ns in groups.items() for n in ns], "g int, n bigint")
    for row in pareto_head(items, ["g"], "n", share).collect():
        ns = sorted(groups[row.g], reverse=True)
        reached, head = 0, 0
        while reached / sum(ns) < share:
            reached, head = reached + ns[head], head + 1
        assert (row["head"], row["items"]) == (head, len(ns))


def test_home_tie_goes_to_the_smallest_id(inputs):
    rows = [{"at": NIGHT, "from": antenna} for antenna in ("2", "1", "2", "1")] + [{"at": 0, "from": "1"}]
    home = FEATURES["percent_at_home"].long(inputs(*rows))
    assert cell(home).value == pytest.approx(3 / 5)
    assert cell(home, daytime="day").value == 1.0
    assert cell(home, daytime="night").value == 0.5


def test_no_night_no_home(inputs):
    assert FEATURES["percent_at_home"].long(inputs({"at": 0, "from": "1"})).where("caller_id = 'A'").count() == 0


def test_radius_of_gyration(inputs):
    # Two points two degrees apart on the equator: both one degree from their mean.
    got = inputs({"at": 0, "from": "1"}, {"at": 1, "from": "2"}, {"at": 2, "from": "3"}, {"at": 3, "from": "9"})
    assert cell(FEATURES["radius_of_gyration"].long(got)).value == pytest.approx(6371 * math.pi / 180)


def test_interevent_time_per_cell(inputs):
    # Day, night, day: the second day call follows the first one in its own cell.
    got = inputs({"at": 0}, {"at": NIGHT}, {"at": 86400})
    gaps = FEATURES["interevent_time"].long(got)
    assert cell(gaps, daytime="day", txn_type="call")["mean"] == 86400.0
    assert cell(gaps, daytime="night", txn_type="call")["mean"] is None
    assert (cell(gaps, txn_type="call")["min"], cell(gaps, txn_type="call")["max"]) == (43200, 43200)


def test_balance_and_contacts(inputs):
    got = inputs({"at": 0}, {"at": 1}, {"at": 2, "a": "B", "b": "A"}, {"at": 3, "b": "C"})
    balance = cell(FEATURES["balance_of_contacts"].long(got), txn_type="call")
    assert balance["mean"] == pytest.approx((2 / 3 + 1) / 2)
    assert cell(FEATURES["number_of_contacts"].long(got), txn_type="call").value == 2
    per_contact = cell(FEATURES["interactions_per_contact"].long(got), txn_type="call")
    assert (per_contact["mean"], per_contact["median"], per_contact["max"]) == (2.0, 1, 3)
    assert cell(FEATURES["percent_initiated_interactions"].long(got)).value == 0.75


def test_call_to_oneself_counts_in_both_directions(inputs):
    got = inputs({"at": 0, "b": "A", "duration": 10.0}, {"at": 5, "duration": 5.0})
    n = FEATURES["number_of_interactions"].long(got)
    assert [cell(n, txn_type="call", direction=d).value for d in ("in", "out", "alldir")] == [1, 2, 3]
    contacts = got.contacts.where("weekday = 'allweek' AND daytime = 'allday' AND caller_id = 'A'")
    assert as_set(contacts.select("recipient_id", "n_out", "n_in", F.col("seconds").cast("double"))) == {
        ("A", 1, 1, 20.0), ("B", 1, 0, 5.0),
    }


def test_weekend_and_night(inputs):
    saturday = datetime(2024, 1, 6, 6, 59, 59)
    got = inputs({"at": saturday, "type": "text"}, {"at": saturday.replace(hour=7, minute=0, second=0), "type": "text"},
                 {"at": saturday.replace(hour=19, minute=0, second=0), "type": "text"})
    assert cell(FEATURES["percent_nocturnal"].long(got), weekday="weekend", txn_type="text").value == pytest.approx(2 / 3)
    days = FEATURES["active_days"].long(got)
    assert [cell(days, weekday="weekend", daytime=d).value for d in ("day", "night", "allday")] == [1, 1, 1]
    assert days.where("weekday = 'weekday'").count() == 0


@pytest.mark.parametrize("names", [["weekday"], ["weekday", "daytime"], ["weekday", "daytime", "direction"]])
def test_totals_equal_repeated_rows(records, names):
    df = directed_interactions(records(*calls("BCBD"), {"at": NIGHT}), Calendar())
    repeated = df
    for name in names:
        repeated = repeated.withColumn(name, F.explode(F.array(F.col(name), F.lit(VOCABULARY[name][-1]))))
    assert repeated.count() == 2 ** len(names) * df.count()
    expected = repeated.groupBy("caller_id", *names).agg(F.countDistinct("recipient_id").alias("n"))
    got = group_with_totals(df, ["caller_id"], names, F.countDistinct("recipient_id").alias("n"))
    assert as_set(expected) == as_set(got.select(expected.columns))


def test_a_huge_duration_does_not_end_the_run(inputs):
    got = inputs({"at": 0, "duration": 1e15}, {"at": 60, "duration": 30.0})
    row = cell(FEATURES["call_duration"].long(got))
    assert row["max"] == 1e15 and row["mean"] == 30.0
    assert FEATURES["percent_pareto_durations"].long(got).count() > 0


def test_wide_has_every_column(inputs):
    """Also when there are only calls: labels are complete, text columns are null."""
    got = inputs({"at": 0, "duration": 1.0})
    columns = {name: feature.wide(got).columns for name, feature in FEATURES.items()}
    assert sum(len(names) - 1 for names in columns.values()) == 708
    row = FEATURES["number_of_contacts"].wide(got).where("caller_id = 'A'").first()
    assert row.number_of_contacts_allweek_allday_call == 1
    assert row.number_of_contacts_allweek_allday_text is None
    assert "number_of_interactions_alldir_allweek_night_text" in columns["number_of_interactions"]
    assert {f"call_duration_weekend_day_call_{s}" for s in STATS} <= set(columns["call_duration"])
    assert "percent_nocturnal_allweek_call" in columns["percent_nocturnal"]
    assert "response_delay_text_weekday_allday_median" in columns["response_delay_text"]


def test_other_types_count_where_type_is_no_key(inputs):
    got = inputs({"at": 0, "type": "mms", "from": "1"})
    assert cell(FEATURES["active_days"].long(got)).value == 1
    assert cell(FEATURES["number_of_antennas"].long(got)).value == 1
    assert cell(FEATURES["number_of_contacts"].long(got), txn_type="mms").value == 1
    assert FEATURES["number_of_contacts"].wide(got).columns == FEATURES["number_of_contacts"].wide(inputs({"at": 0})).columns
    more = inputs({"at": 0, "type": "mms"}, txn_types=("call", "text", "mms"))
    assert FEATURES["number_of_contacts"].wide(more).first().number_of_contacts_weekday_day_mms == 1
