"""Statistics from counts of values, against plain arithmetic and Spark's own aggregates."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from callgrain.operators.value_counts import cells_of_counts, counted_stats, value_counts


def rows_of(spark, seed=5):
    rng = random.Random(seed)
    rows = [(f"c{k % 5}", rng.choice(["weekday", "weekend"]), rng.choice(["day", "night"]),
             rng.choice([None, 0.5, 1.25, 2.0, 3.0, rng.random() * 100])) for k in range(400)]
    rows += [("one", "weekday", "day", 7.0), ("same", "weekday", "day", 0.1), ("same", "weekday", "day", 0.1), ("same", "weekday", "day", 0.1),
             ("none", "weekend", "night", None), ("even", "weekday", "day", 1.0), ("even", "weekday", "day", 9.0)]
    return spark.createDataFrame(rows, "caller_id string, weekday string, daytime string, v double"), rows


def in_cell(row, weekday, daytime):
    return weekday in (row[1], "allweek") and daytime in (row[2], "allday")


def test_equals_plain_statistics(spark):
    df, rows = rows_of(spark)
    found = counted_stats(
        cells_of_counts(value_counts(df, ["caller_id"], "v"), ["caller_id"], "v"), ["caller_id", "weekday", "daytime"], "v")
    seen = set()
    for r in found.collect():
        seen.add((r["caller_id"], r["weekday"], r["daytime"]))
        values = sorted(x[3] for x in rows if x[0] == r["caller_id"] and in_cell(x, r["weekday"], r["daytime"]) and x[3] is not None)
        if not values:
            assert all(r[c] is None for c in ("mean", "std", "median", "skewness", "kurtosis", "min", "max"))
            continue
        n, exact = len(values), [Fraction(v) for v in values]
        mean = sum(exact) / n
        m2, m3, m4 = (sum((v - mean) ** k for v in exact) for k in (2, 3, 4))
        assert r["median"] == values[(n - 1) // 2] and (r["min"], r["max"]) == (values[0], values[-1])
        assert abs(r["mean"] - float(mean)) < 1e-6 and abs(r["std"] - float(m2 / n) ** 0.5) < 1e-9
        if m2 == 0:
            assert r["std"] == 0 and r["skewness"] is None and r["kurtosis"] is None
        else:
            assert abs(r["skewness"] - n ** 0.5 * float(m3) / float(m2) ** 1.5) < 1e-8
            assert abs(r["kurtosis"] - (n * float(m4) / float(m2) ** 2 - 3)) < 1e-8
    wanted = {(x[0], w, d) for x in rows for w in (x[1], "allweek") for d in (x[2], "allday")}
    assert seen == wanted


def test_bit_equal_for_any_number_of_partitions(spark):
    df, _ = rows_of(spark, seed=6)

    def result(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            counts = value_counts(df.repartition(int(partitions)), ["caller_id"], "v").repartition("caller_id")
            return set(map(tuple, counted_stats(
                cells_of_counts(counts, ["caller_id"], "v"), ["caller_id", "weekday", "daytime"], "v").collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    assert result("1") == result("8") == result("200")


def test_counts_stand_for_rows(spark):
    df = spark.createDataFrame([("a", 3, 2), ("a", 5, 1), ("a", None, 9), ("b", None, 1)], "k string, v int, n long")
    rows = {r["k"]: r for r in counted_stats(df, ["k"], "v").collect()}
    plain = spark.createDataFrame([(3,), (3,), (5,)], "v int").agg(
        F.mean("v"), F.stddev_pop("v"), F.percentile_approx("v", 0.5), F.skewness("v"), F.kurtosis("v")).first()
    assert [round(x, 9) for x in list(rows["a"])[1:6]] == [round(x, 9) for x in plain]
    assert list(rows["b"])[1:] == [None] * 7
