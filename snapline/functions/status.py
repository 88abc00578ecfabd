"""Health measures: status levels, ages, clamped lag."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Status labels, and the factor between "degraded" and "down".
HEALTHY, DEGRADED, DOWN = "healthy", "degraded", "down"
DOWN_FACTOR = 3


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status_of(age, threshold) -> Column:
    """``age <= T`` healthy, ``<= 3T`` degraded, else down (bounds inclusive).

    Compare the unrounded age; NULL age -> down.
    """
    a, t = _c(age), (F.lit(threshold) if not isinstance(threshold, Column) else threshold)
    return (F.when(a <= t, F.lit(HEALTHY))
            .when(a <= t * DOWN_FACTOR, F.lit(DEGRADED))
            .otherwise(F.lit(DOWN)))


def clamp_lag(high, committed) -> Column:
    """``max(high - committed, 0)``, NULL when the high watermark is unknown."""
    h, c = _c(high), _c(committed)
    return F.when(h.isNotNull() & c.isNotNull(), F.greatest(h - c, F.lit(0)))


def age_seconds(now, then) -> Column:
    """Seconds between two UTC wall-clock timestamps, exact to the microsecond."""
    return (F.unix_micros(_c(now).cast("timestamp")) - F.unix_micros(_c(then).cast("timestamp"))) / F.lit(1e6)


def round_tenth(c) -> Column:
    """Round to one decimal, half to even (0.25 -> 0.2, like Python's ``round``)."""
    return F.bround(_c(c), 1)
