"""Call records, antennas and cells derived from the given tables, in Spark and in SQL.

Every row of `events` is one record. Contacts are an exclusive-or of ids, hence symmetric, so that
replies occur; some ids are short, some antennas are missing, and two are in no cell.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from callgrain.params import FeatureParams, Period
from callgrain.plans.features import FeatureInputs

# The span of `events`, and the date up to which regional aggregates run.
PERIOD = Period(date(2024, 1, 1), date(2024, 1, 30))
AS_OF = Period(date(2024, 1, 1), date(2024, 1, 31))


IS_TEXT = "event_type IN ('click', 'view', 'signup')"


def _subscriber(number: str) -> str:
    return (f"if({number} % 40 = 39, 'short-' || CAST({number} AS string), "
            f"'sub-' || lpad(CAST({number} AS string), 18, '0'))")


def cdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id", f"{_subscriber('user_id')} AS caller_id",
        f"{_subscriber('(user_id ^ (1 + event_id % 3))')} AS recipient_id",
        "date_trunc('second', ts) AS timestamp", "date_trunc('day', ts) AS day",
        f"if({IS_TEXT}, 'text', 'call') AS txn_type", f"if({IS_TEXT}, NULL, value) AS duration",
        "if(event_id % 29 = 0, NULL, CAST((event_id * 7) % 27 AS string)) AS caller_antenna",
        "if(event_id % 31 = 0, NULL, CAST((event_id * 11 + 3) % 27 AS string)) AS recipient_antenna",
    )


# All but one in forty records of a day moved to its first second: many rows of one time beside few of others.
IS_MOVED = "event_id % 40 <> 7"


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.expr(f"if({IS_MOVED}, day, timestamp)")
    return cdr(spark, sf_dir).withColumn("timestamp", moved)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.selectExpr("CAST(n_nationkey AS string) AS cell_id", "r_name AS region")


def antennas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/nation.parquet").selectExpr(
        "CAST(n_nationkey AS string) AS antenna_id", "CAST(12.0 + n_nationkey * 0.15 AS double) AS latitude",
        "CAST(-16.0 + (n_nationkey * 7 % 25) * 0.2 AS double) AS longitude",
    )


def feature_inputs(spark: SparkSession, sf_dir: str, params: FeatureParams | None = None,
                   records=cdr) -> FeatureInputs:
    return FeatureInputs(records(spark, sf_dir), antennas(spark, sf_dir), params or FeatureParams())


CDR_SQL = """
base AS (
  SELECT event_id, value, user_id AS u, xor(user_id, 1 + event_id % 3) AS v, date_trunc('second', ts) AS ts0,
    CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'text' ELSE 'call' END AS txn_type
  FROM events),
cdr AS (
  SELECT event_id,
    CASE WHEN u % 40 = 39 THEN 'short-' || CAST(u AS VARCHAR) ELSE 'sub-' || lpad(CAST(u AS VARCHAR), 18, '0') END AS caller_id,
    CASE WHEN v % 40 = 39 THEN 'short-' || CAST(v AS VARCHAR) ELSE 'sub-' || lpad(CAST(v AS VARCHAR), 18, '0') END AS recipient_id,
    ts0 AS timestamp, date_trunc('day', ts0) AS day, txn_type,
    CASE WHEN txn_type = 'call' THEN value END AS duration,
    CASE WHEN event_id % 29 <> 0 THEN CAST((event_id * 7) % 27 AS VARCHAR) END AS caller_antenna,
    CASE WHEN event_id % 31 <> 0 THEN CAST((event_id * 11 + 3) % 27 AS VARCHAR) END AS recipient_antenna
  FROM base)"""

BURSTS_SQL = CDR_SQL.replace(
    "date_trunc('second', ts) AS ts0",
    f"CASE WHEN {IS_MOVED} THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS ts0")

CELLS_SQL = """
cells AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS cell_id, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

ANTENNAS_SQL = """
antennas AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS antenna_id, CAST(12.0 + n_nationkey * 0.15 AS DOUBLE) AS latitude,
    CAST(-16.0 + (n_nationkey * 7 % 25) * 0.2 AS DOUBLE) AS longitude
  FROM nation)"""
