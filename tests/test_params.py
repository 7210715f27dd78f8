from datetime import date

import pytest
from pyspark.sql import functions as F

from callgrain.functions.calendar import bucket, first_monday, last_sunday
from callgrain.params import MORE_THAN_15, AT_LEAST_15, Period


@pytest.mark.parametrize("start, end, monday, sunday", [
    (date(2021, 5, 1), date(2021, 5, 31), date(2021, 5, 3), date(2021, 5, 30)),
    (date(2024, 1, 1), date(2024, 1, 28), date(2024, 1, 1), date(2024, 1, 28)),
    (date(2024, 1, 2), date(2024, 1, 27), date(2024, 1, 8), date(2024, 1, 21)),
])
def test_full_weeks(spark, start, end, monday, sunday):
    assert Period(start, end).full_weeks() == Period(monday, sunday)
    row = spark.createDataFrame([(start, end)], "start date, end date").select(
        first_monday("start").alias("m"), last_sunday("end").alias("s")
    ).first()
    assert (row.m, row.s) == (monday, sunday)


def test_period_ends_before_next_midnight(spark):
    period = Period(date(2024, 1, 1), date(2024, 1, 2))
    moments = spark.createDataFrame(
        [("2023-12-31 23:59:59",), ("2024-01-01 00:00:00",), ("2024-01-02 23:59:59",), ("2024-01-03 00:00:00",)], "t string"
    ).withColumn("t", F.to_timestamp("t"))
    kept = [str(row.t) for row in moments.where(period.covers("t")).orderBy("t").collect()]
    assert kept == ["2024-01-01 00:00:00", "2024-01-02 23:59:59"]


def test_privacy_at_the_threshold(spark):
    counts = spark.createDataFrame([(14,), (15,), (16,)], "n int")
    assert [r.n for r in counts.where(AT_LEAST_15.allows("n")).orderBy("n").collect()] == [15, 16]
    assert [r.n for r in counts.where(MORE_THAN_15.allows("n")).collect()] == [16]


def test_unknown_frequency():
    with pytest.raises(ValueError):
        bucket("t", "year")
