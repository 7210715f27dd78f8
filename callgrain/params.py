"""Parameters of the computations, as plain immutable values."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

# Category labels, part of the output format (they become column names).
WEEKDAYS = ("weekday", "weekend")
DAYTIMES = ("day", "night")
DIRECTIONS = ("in", "out")
ALL_WEEK, ALL_DAY, ALL_DIR = "allweek", "allday", "alldir"
CALL, TEXT = "call", "text"
TXN_TYPES = (CALL, TEXT)
STATS = ("mean", "std", "median", "skewness", "kurtosis", "min", "max")
UNMAPPED_REGION = "99999"
FREQUENCIES = ("hour", "day", "week", "month")


@dataclass(frozen=True)
class Calendar:
    """What counts as weekend (Spark's dayofweek, 1 = Sunday) and as daytime."""

    weekend: tuple[int, ...] = (1, 7)
    start_of_day: int = 7
    end_of_day: int = 19


@dataclass(frozen=True)
class Period:
    """A run of whole days; both ends belong to it."""

    start: date
    end: date

    def covers(self, column: Column | str) -> Column:
        """Predicate on a timestamp or date column: from `start` up to the end of `end`."""
        column = F.col(column) if isinstance(column, str) else column
        return (column >= F.lit(self.start)) & (column < F.lit(self.end + timedelta(days=1)))

    def prune(self, df: DataFrame, column: str = "timestamp") -> DataFrame:
        """Rows that the period covers. Where the table has their `day` too, as records do, that is asked for as well,
        so that a scan of records stored by day skips whole directories."""
        rows = df.where(self.covers(column))
        return rows.where(self.covers("day")) if "day" in df.columns and column != "day" else rows

    def union(self, other: Period | None) -> Period:
        """From the first start to the last end."""
        return self if other is None else Period(min(self.start, other.start), max(self.end, other.end))

    def full_weeks(self) -> Period:
        """The part made of whole Monday-to-Sunday weeks."""
        first_monday = self.start + timedelta(days=-self.start.weekday() % 7)
        last_sunday = self.end - timedelta(days=(self.end.weekday() + 1) % 7)
        return Period(first_monday, last_sunday)


@dataclass(frozen=True)
class Privacy:
    """Smallest count that may be published; `strict` also hides that count itself."""

    min_count: int = 15
    strict: bool = False

    def allows(self, count: Column | str) -> Column:
        count = F.col(count) if isinstance(count, str) else count
        return count > self.min_count if self.strict else count >= self.min_count


AT_LEAST_15 = Privacy(15, strict=False)
MORE_THAN_15 = Privacy(15, strict=True)


@dataclass(frozen=True)
class GroupSplit:
    """When an ordered group (a caller, a pair, a subscriber) is too large for one task: it is cut along its
    order into runs of about this many rows, at any size of the data.

    Sizes are estimated on a share of all rows that leaves `rows_to_see` of a group at the limit.
    """

    rows_per_group: int = 5_000_000
    rows_to_see: int = 10_000


@dataclass(frozen=True)
class FeatureParams:
    calendar: Calendar = field(default_factory=Calendar)
    max_wait: int = 3600
    pareto_share: float = 0.8
    txn_types: tuple[str, ...] = TXN_TYPES
    split: GroupSplit = field(default_factory=GroupSplit)
