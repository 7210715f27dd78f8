"""Aggregate expressions. All of them merge, so Spark combines them before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wide enough for any duration in seconds, with microseconds.
EXACT = "decimal(20,6)"
# Twelve places for sums of doubles below a million million.
FIXED = "decimal(26,12)"


def steady_sum(value: Column) -> Column:
    """Sum of doubles of ordinary size in fixed point, which does not depend on the order of rows."""
    return F.sum(value.cast(FIXED)).cast("double")


def shannon_entropy(n: Column | str, times: Column | str | None = None) -> Column:
    """Entropy in nats of the shares of counts `n`, in one pass; each count occurs `times` times.

    -sum(n/T ln(n/T)) equals ln(T) - sum(n ln n)/T, which needs no total beforehand.
    """
    n = F.col(n) if isinstance(n, str) else n
    times = F.lit(1) if times is None else F.col(times) if isinstance(times, str) else times
    total = F.sum(n * times)
    return F.greatest(F.ln(total) - steady_sum(n * times * F.ln(n)) / total, F.lit(0.0))


def share(condition: Column) -> Column:
    """Share of rows for which a condition holds (null counts as not)."""
    return F.mean(F.when(condition, 1).otherwise(0))
