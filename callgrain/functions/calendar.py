"""Labels and buckets taken from timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from callgrain.params import DAYTIMES, FREQUENCIES, WEEKDAYS, Calendar


def weekday_label(day: Column | str, calendar: Calendar) -> Column:
    is_weekend = F.dayofweek(day).isin(*calendar.weekend)
    return F.when(is_weekend, WEEKDAYS[1]).otherwise(WEEKDAYS[0])


def daytime_label(timestamp: Column | str, calendar: Calendar) -> Column:
    hour = F.hour(timestamp)
    is_night = (hour < calendar.start_of_day) | (hour >= calendar.end_of_day)
    return F.when(is_night, DAYTIMES[1]).otherwise(DAYTIMES[0])


def bucket(timestamp: Column | str, frequency: str) -> Column:
    """Start of the hour, day, week (Monday) or month."""
    if frequency not in FREQUENCIES:
        raise ValueError(f"frequency must be one of {FREQUENCIES}, not {frequency!r}")
    return F.date_trunc(frequency, timestamp)


def first_monday(start: Column | str) -> Column:
    """First Monday on or after a date."""
    return F.next_day(F.date_sub(start, 1), "MO")


def last_sunday(end: Column | str) -> Column:
    """Last Sunday on or before a date."""
    return F.date_sub(F.next_day(end, "SU"), 7)
