"""Call detail records, antennas and the cell-to-region map: reading and cleaning."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from callgrain.functions.stats import EXACT
from callgrain.params import Period

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

CDR_COLUMNS = (
    "caller_id", "recipient_id", "timestamp", "txn_type", "duration", "caller_antenna", "recipient_antenna",
)
ANTENNA_COLUMNS = ("antenna_id", "latitude", "longitude")
CELL_COLUMNS = {"Cell_ID_LAC": "cell_id", "UA": "region"}


def require_columns(df: DataFrame, columns, what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the column(s) {', '.join(missing)}")


def read_csv(spark: SparkSession, paths: str | list[str], columns, what: str, sep: str = ",") -> DataFrame:
    """Named text columns of one or more CSV files with a header."""
    df = spark.read.csv(paths, header=True, sep=sep)
    require_columns(df, columns, what)
    return df.select(*columns)


def read_cdr(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw records, every column as text. `paths` may hold globs."""
    return read_csv(spark, paths, CDR_COLUMNS, "the CDR")


def read_antennas(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    raw = read_csv(spark, paths, ANTENNA_COLUMNS, "the antenna table")
    return raw.select(
        "antenna_id",
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
    )


def read_cells(spark: SparkSession, paths: str | list[str], columns: dict[str, str] | None = None,
               sep: str = ",") -> DataFrame:
    """Cell-to-region map: two columns picked and renamed, rows without a cell dropped."""
    columns = columns or CELL_COLUMNS
    raw = read_csv(spark, paths, tuple(columns), "the cell map", sep)
    return raw.select(*[F.col(old).alias(new) for old, new in columns.items()]).dropna(subset=["cell_id"])


def _parsed(raw: DataFrame) -> tuple[Column, Column]:
    timestamp = F.try_to_timestamp(F.col("timestamp").cast("string"), F.lit(TIMESTAMP_FORMAT))
    duration = F.col("duration").try_cast("double")
    return timestamp, duration


def _typed(raw: DataFrame) -> DataFrame:
    timestamp, duration = _parsed(raw)
    event_id = F.col("event_id") if "event_id" in raw.columns else F.monotonically_increasing_id()
    return raw.select(
        event_id.cast("bigint").alias("event_id"), "caller_id", "recipient_id",
        timestamp.alias("timestamp"), "txn_type", duration.alias("duration"),
        "caller_antenna", "recipient_antenna", F.struct(*[F.col(c).cast("string").alias(c) for c in CDR_COLUMNS]).alias("raw"),
    )


def clean_cdr(raw: DataFrame) -> DataFrame:
    """Typed records. Rows without a readable timestamp are left out; see `rejects` and `sinks.land_with_quarantine`.

    `event_id` orders records of the same second. Where the source has none, each row gets a
    number that follows its place in the files; land the result (`sinks.land_cdr`) to keep it.
    """
    return _typed(raw).drop("raw").dropna(subset=["timestamp"]).withColumn("day", F.date_trunc("day", "timestamp"))


def with_reasons(raw: DataFrame) -> DataFrame:
    """Typed records, all of them, with `day`, the fields as they were (`raw`) and `reasons`, why a record cannot be landed.

    Reasons are `timestamp` (unreadable or missing) and `duration` (given, but no number or too large). A missing id is none: such
    records are visits of the other party.
    """
    text = F.col("raw")["duration"]
    bad = {
        "timestamp": F.col("timestamp").isNull(),
        "duration": text.isNotNull() & F.col("duration").try_cast(EXACT).isNull(),
    }
    reasons = F.filter(F.array(*[F.when(when, F.lit(name)) for name, when in bad.items()]), lambda r: r.isNotNull())
    return _typed(raw).withColumns({"day": F.date_trunc("day", "timestamp"), "reasons": reasons})


def rejects(raw: DataFrame) -> DataFrame:
    """One row of counts: what cannot be used. Records without both ids give no interactions."""
    timestamp, duration = _parsed(raw)
    return raw.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("caller_id").isNull() | F.col("recipient_id").isNull()).alias("without_ids"),
        F.count_if(timestamp.isNull()).alias("bad_timestamp"),
        F.count_if(F.col("duration").isNotNull() & duration.try_cast(EXACT).isNull()).alias("bad_duration"),
    )


def filter_dates(df: DataFrame, start: date, end: date, column: str = "timestamp") -> DataFrame:
    """Rows from `start` to the end of the day `end`; of records stored by day, only those days are read."""
    if column not in df.columns:
        raise ValueError(f"cannot filter by date: there is no column {column!r}")
    return Period(start, end).prune(df, column)


def join_on(tables: list[DataFrame], on: str | list[str], how: str) -> DataFrame:
    """Join a list of tables by one key."""
    return reduce(lambda left, right: left.join(right, on=on, how=how), tables)
