from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta

import pytest
from pyspark.sql import SparkSession, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


CDR = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("caller_id", T.StringType()),
    T.StructField("recipient_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("txn_type", T.StringType()), T.StructField("duration", T.DoubleType()),
    T.StructField("caller_antenna", T.StringType()), T.StructField("recipient_antenna", T.StringType()),
])
# A Monday morning.
START = datetime(2024, 1, 1, 10, 0, 0)


@pytest.fixture
def records(spark):
    """Make records from dicts; `at` is seconds after START, ids follow the order of the list."""
    def make(*rows):
        full = []
        for number, row in enumerate(rows):
            moment = row["at"] if isinstance(row["at"], datetime) else START + timedelta(seconds=row["at"])
            full.append((
                row.get("id", number), row.get("a", "A"), row.get("b", "B"), moment, row.get("type", "call"),
                row.get("duration"), row.get("from"), row.get("to"),
            ))
        return spark.createDataFrame(full, CDR).withColumn("day", F.date_trunc("day", "timestamp"))

    return make


@pytest.fixture
def antennas(spark):
    return spark.createDataFrame(
        [("1", 0.0, 0.0), ("2", 0.0, 2.0), ("3", None, 5.0)], "antenna_id string, latitude double, longitude double"
    )


@pytest.fixture
def inputs(records, antennas):
    from callgrain.params import FeatureParams
    from callgrain.plans.features import FeatureInputs

    def make(*rows, **params):
        return FeatureInputs(records(*rows), antennas, FeatureParams(**params))

    return make


def as_set(df):
    return {tuple(row) for row in df.collect()}


def cell(df, caller="A", weekday="allweek", daytime="allday", **more):
    """The one row of a long feature in a cell."""
    df = df.where((F.col("caller_id") == caller) & (F.col("weekday") == weekday))
    if "daytime" in df.columns:
        df = df.where(F.col("daytime") == daytime)
    for name, value in more.items():
        df = df.where(F.col(name) == value)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
