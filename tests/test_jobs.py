"""The jobs, and properties that hold for any records."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from callgrain.operators.visits import visits
from callgrain.params import FeatureParams, Period
from callgrain.plans import jobs
from callgrain.plans.features import FEATURES, FeatureInputs
from callgrain.sources.cdr import filter_dates
from callgrain.sources.runs import Run
from callgrain.sources.sinks import land_cdr
from conftest import as_set
from test_splitting import lopsided


@pytest.fixture(scope="module")
def rows():
    return lopsided(seed=11, rows=300)


def test_feature_job_equals_single_features(spark, records, antennas, rows, tmp_path):
    names = ["number_of_interactions", "percent_nocturnal", "response_delay_text", "percent_at_home", "interevent_time"]
    df = records(*rows)
    paths = jobs.write_features(df, antennas, str(tmp_path / "long"), names=names, wide=False)
    assert list(paths) == names
    single = FeatureInputs(df, antennas, FeatureParams())
    for name in names:
        assert as_set(spark.read.parquet(paths[name])) == as_set(FEATURES[name].long(single)), name


def test_feature_table_has_a_row_per_caller(spark, records, antennas, rows, tmp_path):
    names = ["active_days", "percent_at_home"]
    paths = jobs.write_features(records(*rows), antennas, str(tmp_path), names=names)
    table = jobs.feature_table([spark.read.parquet(p) for p in paths.values()])
    assert table.count() == table.select("caller_id").distinct().count()
    assert len(table.columns) == 1 + 9 + 9


@pytest.mark.parametrize("by_subscriber, tables", [(False, 5), (True, 6)])
def test_mobility_job(spark, records, tmp_path, by_subscriber, tables):
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    df = records(*[{"a": f"{n % 20:020d}", "b": f"{n % 7:020d}", "from": "12"[n % 2], "to": "1", "at": 500 * n} for n in range(400)])
    paths = jobs.write_mobility(
        df, cells, str(tmp_path), Period(date(2024, 1, 1), date(2024, 1, 31)), by_subscriber=by_subscriber
    )
    assert len(paths) == tables
    columns = spark.read.parquet(paths["origin_destination_per_day"]).columns
    assert ("msisdn" in columns) == by_subscriber
    assert spark.read.parquet(paths["unique_subscribers_country_per_day"]).count() > 0


def test_mobility_job_exchanges_nothing_more_by_subscriber(spark, records, tmp_path, monkeypatch):
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    df = records(*[{"a": f"{n % 20:020d}", "b": f"{n % 7:020d}", "from": "12"[n % 2], "to": "1", "at": 500 * n} for n in range(400)])
    plans, publish = {}, Run.publish

    def seen(self, name, make):
        plans[name] = _reads(make())
        return publish(self, name, make)

    monkeypatch.setattr(Run, "publish", seen)
    jobs.write_mobility(df, cells, str(tmp_path), Period(date(2024, 1, 1), date(2024, 1, 31)), by_subscriber=True)
    assert "Exchange" in plans["unique_subscribers_per_hour"]
    for name in ("transactions_per_hour", "origin_destination_per_day", "subscriber_home_regions_per_day"):
        assert "Exchange" not in plans[name], name


@pytest.mark.parametrize("name", [
    "response_delay_text", "interevent_time", "percent_pareto_durations", "radius_of_gyration", "entropy_of_contacts",
    "entropy_of_antennas", "balance_of_contacts", "call_duration",
])
def test_partitions_do_not_matter(spark, records, antennas, rows, name):
    def result(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            df = FEATURES[name].long(FeatureInputs(records(*rows).repartition(7), antennas, FeatureParams()))
            return as_set(df)  # to the last bit
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert result("1") == result("8") == result("200")


def test_totals_and_ranges(records, antennas, rows):
    inputs = FeatureInputs(records(*rows), antennas, FeatureParams())
    n = FEATURES["number_of_interactions"].long(inputs)
    keys = ["caller_id", "daytime", "txn_type", "direction"]
    sums = n.groupBy(*keys).agg(
        F.sum(F.when(F.col("weekday") == "allweek", F.col("value")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("weekday") != "allweek", F.col("value")).otherwise(0)).alias("b"),
    )
    assert sums.where("a <> b").count() == 0
    sides = n.groupBy("caller_id", "weekday", "daytime", "txn_type").agg(
        F.sum(F.when(F.col("direction") == "alldir", F.col("value")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("direction") != "alldir", F.col("value")).otherwise(0)).alias("b"),
    )
    assert sides.where("a <> b").count() == 0
    for name, feature in FEATURES.items():
        if name.startswith("percent") or name == "response_rate_text":
            assert feature.long(inputs).where("value < 0 OR value > 1").count() == 0, name
    contacts = FEATURES["number_of_contacts"].long(inputs).withColumnRenamed("value", "n")
    entropies = FEATURES["entropy_of_contacts"].long(inputs).join(contacts, ["caller_id", "weekday", "daytime", "txn_type"])
    assert entropies.where("value < 0 OR value > ln(n) + 1e-9").count() == 0


def _reads(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_periods_reach_the_partitions(spark, records, rows, tmp_path):
    landed_at = str(tmp_path / "landed")
    land_cdr(records(*rows), landed_at)
    landed = spark.read.parquet(landed_at)
    day = Period(date(2024, 1, 1), date(2024, 1, 1))
    for df in (filter_dates(landed, day.start, day.end), visits(day.union(None).prune(landed))):
        filters = re.search(r"PartitionFilters: \[(.*?)\]", _reads(df)).group(1)
        assert "day" in filters, _reads(df)
    whole = as_set(day.prune(records(*rows)).select("event_id"))
    assert as_set(filter_dates(landed, day.start, day.end).select("event_id")) == whole


def test_jobs_read_only_their_period(spark, records, tmp_path, monkeypatch):
    """Records outside the periods do not reach the stored tables."""
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    df = records(*[{"a": f"{n % 5:020d}", "b": "x" * 20, "from": "1", "to": "2", "at": 86_400 * n} for n in range(40)])
    stored = {}
    monkeypatch.setattr(Run, "shared", lambda self, name, make, *more: stored.setdefault(name, make()))
    week = Period(date(2024, 1, 8), date(2024, 1, 14))
    jobs.write_mobility(df, cells, str(tmp_path / "m"), week)
    assert stored["presence"].select("call_date").distinct().count() == 7
    stored.clear()
    jobs.write_regions(df, cells, str(tmp_path / "r"), week, Period(date(2024, 1, 10), date(2024, 1, 16)))
    assert stored["presence"].select("call_date").distinct().count() == 9


def test_stored_contacts_are_no_more_than_the_records(records, antennas, tmp_path):
    df = records(*[{"at": n, "a": f"a{n}", "b": f"b{n}"} for n in range(200)])
    inputs = FeatureInputs(df, antennas, FeatureParams())
    assert inputs.contact_sums.count() == 200 and inputs.contacts.count() == 1600


def _without_broadcast(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _reads(make()).split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_laid_out_features_need_no_exchange(spark, records, antennas, rows, tmp_path):
    """By caller nothing moves after the shared tables are written; only the antennas are joined by another key."""
    with Run(str(tmp_path / "run"), [records(*rows), antennas], ()) as run:
        inputs = FeatureInputs(records(*rows), antennas, FeatureParams()).laid_out(run, 4)
        for name, feature in FEATURES.items():
            plan = _without_broadcast(spark, lambda: feature.wide(inputs))
            if name != "radius_of_gyration":
                assert "Exchange" not in plan, (name, plan)
        single = FeatureInputs(records(*rows), antennas, FeatureParams())
        for name in ("number_of_contacts", "entropy_of_contacts", "percent_pareto_interactions", "call_duration", "interevent_time"):
            rounded = [{tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in FEATURES[name].long(i).collect()}
                       for i in (inputs, single)]
            assert rounded[0] == rounded[1], name
        run.finish()


def _landed(spark, records, rows, folder):
    land_cdr(records(*rows), folder)
    return spark.read.parquet(folder).withColumn("day", F.col("day").cast("timestamp"))


def test_stopped_job_goes_on_where_it_was(spark, records, antennas, rows, tmp_path, monkeypatch):
    cdr = _landed(spark, records, rows, str(tmp_path / "landed"))
    antennas.write.parquet(str(tmp_path / "antennas"))
    places = spark.read.parquet(str(tmp_path / "antennas"))
    names = ["active_days", "number_of_contacts", "percent_nocturnal", "call_duration", "percent_at_home"]
    whole = jobs.write_features(cdr, places, str(tmp_path / "whole"), names=names, table=True)
    out, publish = tmp_path / "out", Run.publish

    def failing(self, name, *args, **kwargs):
        if name == "call_duration":
            raise RuntimeError("an executor too few")
        return publish(self, name, *args, **kwargs)

    monkeypatch.setattr(Run, "publish", failing)
    with pytest.raises(RuntimeError):
        jobs.write_features(cdr, places, str(out), names=names, table=True)
    monkeypatch.setattr(Run, "publish", publish)
    kept = {f: f.stat().st_mtime_ns for name in (*names[:3], "_shared") for f in (out / name).rglob("*.parquet")}
    assert len({f.parts[len(out.parts)] for f in kept}) == 4
    made = []
    monkeypatch.setattr(FeatureInputs, "directed", property(lambda self: made.append(self)))
    paths = jobs.write_features(cdr, places, str(out), names=names, table=True)
    assert not made, "the shared tables were there"
    assert all(f.stat().st_mtime_ns == t for f, t in kept.items() if f.exists()) and (out / "active_days").exists()
    for name in paths:
        found = spark.read.parquet(paths[name])
        assert as_set(found) == as_set(spark.read.parquet(whole[name])), name
        assert found.count() == found.select("caller_id").distinct().count(), name
    assert not (out / "_shared").exists() and not (out / "_building").exists()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("laid_out")]
    again = {f: f.stat().st_mtime_ns for f in out.rglob("*.parquet")}
    jobs.write_features(cdr, places, str(out), names=names, table=True)
    assert again == {f: f.stat().st_mtime_ns for f in out.rglob("*.parquet")}


def test_changed_inputs_or_arguments_start_anew(spark, records, antennas, rows, tmp_path):
    cdr = _landed(spark, records, rows, str(tmp_path / "landed"))
    places = records(*rows[:1]).sparkSession.createDataFrame([("1", "North")], "cell_id string, region string")
    places.write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    period = Period(date(2024, 1, 1), date(2024, 1, 31))
    digest = lambda table, *more: Run(str(tmp_path / "d"), [table, cells], (period, *more)).digest
    first = digest(cdr)
    assert first == digest(spark.read.parquet(str(tmp_path / "landed")).withColumn("day", F.col("day").cast("timestamp")))
    assert first != digest(cdr, 1) and first != digest(cdr.where("event_id > 3"))
    records(*rows[:5]).write.mode("append").partitionBy("day").parquet(str(tmp_path / "landed"))
    assert first != digest(spark.read.parquet(str(tmp_path / "landed")).withColumn("day", F.col("day").cast("timestamp")))
    assert digest(records(*rows)) != digest(records(*rows)), "rows that are in no file are not compared"


def test_stopped_mobility_job(spark, records, tmp_path, monkeypatch):
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    cells.write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    rows = [{"a": f"{n % 20:020d}", "b": f"{n % 7:020d}", "from": "12"[n % 2], "to": "1", "at": 500 * n} for n in range(400)]
    cdr = _landed(spark, records, rows, str(tmp_path / "landed"))
    period, publish = Period(date(2024, 1, 1), date(2024, 1, 31)), Run.publish
    whole = jobs.write_mobility(cdr, cells, str(tmp_path / "whole"), period)
    count = []

    def failing(self, name, *args, **kwargs):
        count.append(name)
        if len(count) == 4:
            raise RuntimeError("stopped")
        return publish(self, name, *args, **kwargs)

    monkeypatch.setattr(Run, "publish", failing)
    with pytest.raises(RuntimeError):
        jobs.write_mobility(cdr, cells, str(tmp_path / "out"), period)
    monkeypatch.setattr(Run, "publish", publish)
    held = [tmp_path / "out" / name for name in count[:3]]
    times = [sorted((f, f.stat().st_mtime_ns) for f in p.rglob("*.parquet")) for p in held]
    monkeypatch.setattr(jobs, "presence_per_hour", None)
    paths = jobs.write_mobility(cdr, cells, str(tmp_path / "out"), period)
    assert times == [sorted((f, f.stat().st_mtime_ns) for f in p.rglob("*.parquet")) for p in held]
    for name in whole:
        assert as_set(spark.read.parquet(paths[name])) == as_set(spark.read.parquet(whole[name])), name


def test_feature_table_shuffles_each_table_once(spark, records, antennas, rows, tmp_path):
    names = ["active_days", "percent_at_home", "percent_nocturnal", "number_of_contacts"]
    paths = jobs.write_features(records(*rows), antennas, str(tmp_path), names=names)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _reads(jobs.feature_table([spark.read.parquet(p) for p in paths.values()]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    initial = plan.split("== Initial Plan ==")[-1]
    assert initial.count("SortMergeJoin") == 4 and initial.count("Exchange hashpartitioning") == 1 + 4


def test_job_arguments(spark, records, tmp_path):
    cells = spark.createDataFrame([("1", "North"), ("2", "South")], "cell_id string, region string")
    df = records(*[{"a": f"{n % 20}", "b": f"{n % 7}", "from": "12"[n % 2], "to": "1", "at": 5000 * n} for n in range(400)])
    paths = jobs.write_mobility(
        df, cells, str(tmp_path), Period(date(2024, 1, 1), date(2024, 1, 31)), min_id_length=1, cutoff_days=1,
        publish=None, within=None, visits_per="day", country_per="week", homes_per="week",
    )
    assert {"transactions_per_day", "unique_subscribers_country_per_week", "home_regions_per_week"} <= set(paths)
    counts = spark.read.parquet(paths["transactions_per_day"])
    assert counts.agg(F.sum("count")).first()[0] == 800
