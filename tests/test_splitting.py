"""Cut groups give the same results as whole ones."""

import random

import pytest
from pyspark.sql import functions as F

from callgrain.operators.conversations import tag_pairs
from callgrain.operators.gaps import gaps_between_interactions
from callgrain.operators.interactions import directed_interactions, pair_interactions
from callgrain.operators.pareto import pareto_head
from callgrain.operators.splitting import cut_large_groups
from callgrain.operators.visits import regional_visits, visits, with_neighbours
from callgrain.params import Calendar, GroupSplit
from conftest import as_set

WHOLE = GroupSplit()


def lopsided(seed=3, rows=600):
    """Half of all records between one pair, a third of these within one second, some to oneself."""
    random.seed(seed)
    out = []
    for n in range(rows):
        hot = n % 2 == 0
        a, b = ("A", "B") if hot else (random.choice("ACDEF"), random.choice("ABCDEG"))
        if hot and random.random() < 0.5:
            a, b = b, a
        at = 5000 if hot and n % 3 == 0 else random.randint(0, 40_000)
        out.append({"at": at, "a": a, "b": b, "type": random.choice(["call", "text", "text", "mms"]),
                    "from": random.choice(["1", "2", "7", None]), "to": random.choice(["1", "2"])})
    return out


@pytest.fixture(scope="module")
def hot_rows():
    return lopsided()


@pytest.mark.parametrize("size", [3, 20, 100])
def test_runs_are_small_and_in_order(records, hot_rows, size):
    df = pair_interactions(records(*hot_rows), Calendar()).withColumn("second", F.unix_seconds("timestamp"))
    cut = cut_large_groups(df, ["lo", "hi"], "second", "event_id", GroupSplit(rows_per_group=size))
    assert cut.is_cut and cut.rows.count() == df.count()
    runs = cut.rows.groupBy(*cut.group).agg(
        F.count("*").alias("n"), F.min(F.struct("second", "event_id")).alias("first"),
        F.max(F.struct("second", "event_id")).alias("last"),
    ).orderBy(*cut.group).collect()
    # A call to oneself is two rows of one event, which stay together.
    assert max(r.n for r in runs) <= size + 1
    for before, after in zip(runs, runs[1:]):
        if (before.lo, before.hi) == (after.lo, after.hi):
            assert tuple(before.last) < tuple(after.first)


@pytest.mark.parametrize("size", [3, 20, 100])
def test_tagging(records, hot_rows, size):
    pairs = pair_interactions(records(*hot_rows), Calendar())
    columns = ["event_id", "lo", "hi", "lo_sent", "wait", "conversation", "answers"]
    whole, cut = [
        sorted(map(repr, tag_pairs(pairs, 3600, split).select(*columns).collect()))
        for split in (WHOLE, GroupSplit(rows_per_group=size))
    ]
    assert whole == cut
    assert any("answers=True" in row for row in whole)


@pytest.mark.parametrize("size", [3, 20, 100])
def test_gaps(records, hot_rows, size):
    directed = directed_interactions(records(*hot_rows), Calendar())
    whole, cut = [
        sorted(map(repr, gaps_between_interactions(directed, split).collect()))
        for split in (WHOLE, GroupSplit(rows_per_group=size))
    ]
    assert whole == cut


@pytest.mark.parametrize("size", [3, 20, 100])
def test_neighbours(spark, records, hot_rows, size):
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    homes = spark.createDataFrame([("A", "North"), ("C", "South")], "msisdn string, region string")
    located = regional_visits(visits(records(*hot_rows), min_id_length=1), cells)
    whole, cut = [
        sorted(map(repr, with_neighbours(located, homes, split).collect()))
        for split in (WHOLE, GroupSplit(rows_per_group=size))
    ]
    assert whole == cut and len(whole) == located.count()


@pytest.mark.parametrize("share", [0.3, 0.8, 1.0])
@pytest.mark.parametrize("size", [2, 10, 60])
def test_pareto(spark, size, share):
    random.seed(size)
    rows = [(min(n % 7, 2), round(random.expovariate(0.01), 2)) for n in range(400)] + [(3, 0.0)] * 5 + [(4, 2.5)] * 9
    items = spark.createDataFrame(rows, "g int, v double").selectExpr("g", "CAST(v AS decimal(32,6)) AS v")
    whole, cut = [as_set(pareto_head(items, ["g"], "v", share, split)) for split in (None, GroupSplit(rows_per_group=size))]
    assert whole == cut and len(whole) == 5


def test_sizes_estimated_on_a_share(spark):
    """With a share of the rows seen, the cut may lie elsewhere, but rows stay whole and in order."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                      "id", (F.col("id") / 10).cast("bigint").alias("t"))
    cut = cut_large_groups(rows, ["k"], "t", "id", GroupSplit(500, rows_to_see=50))
    assert cut.is_cut and cut.rows.count() == 20_000
    runs = cut.rows.where("k = 0").groupBy(*cut.group).agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    runs = runs.orderBy(*cut.group).collect()
    assert len(runs) > 5 and max(r.n for r in runs) < 2_000
    assert all(x.b < y.a for x, y in zip(runs, runs[1:]))
    assert cut.rows.where("k <> 0 AND _cut").count() == 0


def test_small_tables_are_left_alone(records):
    df = pair_interactions(records({"at": 0}), Calendar()).withColumn("second", F.unix_seconds("timestamp"))
    assert not cut_large_groups(df, ["lo", "hi"], "second", "event_id", WHOLE).is_cut
    assert not cut_large_groups(df, ["lo", "hi"], "second", "event_id", GroupSplit(5), total=5).is_cut
    # Many rows, but no large group.
    assert not cut_large_groups(df, ["lo", "hi"], "second", "event_id", GroupSplit(rows_per_group=5), total=100).is_cut


def bursts(rows=600):
    """One pair: nearly all records in one second, a few before and after it, so that a sample may miss these."""
    random.seed(5)
    out = []
    for n in range(rows):
        at = 5000 + (random.choice([-7, 7, 90]) if n % 60 == 7 else 0)
        out.append({"at": at, "a": "AB"[n % 2], "b": "BA"[n % 2], "type": random.choice(["call", "text", "text"]),
                    "from": random.choice(["1", "2"]), "to": "1", "duration": float(n)})
    return out


@pytest.mark.parametrize("seen", [1, 4, 1000])
@pytest.mark.parametrize("size", [20, 100])
def test_any_share_gives_the_same_results(spark, records, size, seen):
    df, split = records(*bursts()), GroupSplit(size, rows_to_see=seen)
    pairs, directed = pair_interactions(df, Calendar()), directed_interactions(df, Calendar())
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    homes = spark.createDataFrame([("A", "North")], "msisdn string, region string")
    located = regional_visits(visits(df, min_id_length=1), cells)
    columns = ["event_id", "lo", "hi", "lo_sent", "wait", "conversation", "answers"]
    for result in (
        lambda s: tag_pairs(pairs, 3600, s).select(*columns),
        lambda s: gaps_between_interactions(directed, s),
        lambda s: with_neighbours(located, homes, s),
    ):
        whole, cut = [sorted(map(repr, result(s).collect())) for s in (WHOLE, split)]
        assert whole == cut


def test_null_types_are_cut_too(records):
    df = records(*[{**row, "type": None} for row in bursts(300)])
    directed = directed_interactions(df, Calendar())
    whole, cut = [
        sorted(map(repr, gaps_between_interactions(directed, s).collect())) for s in (WHOLE, GroupSplit(20, rows_to_see=4))
    ]
    assert whole == cut and all("txn_type=None" in row for row in whole)
