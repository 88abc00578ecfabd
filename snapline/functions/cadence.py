"""Night-mode cadence as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Cadence:
    """Polling cadence: base interval, slowed down on weekday nights (local time).

    Fixed defaults: nights are Monday-Friday, 02:00 <= local hour < 05:00 in
    Europe/Paris, interval multiplied by 4. A start hour after the end hour never
    matches (no wrap past midnight).
    """

    base_seconds: int = 60
    enabled: bool = True
    start_hour: int = 2
    end_hour: int = 5
    multiplier: float = 4.0
    tz: str = "Europe/Paris"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_time(ts, tz: str) -> Column:
    """UTC wall clock -> local wall clock in ``tz`` (DST-aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts).cast("timestamp_ntz"))


def is_night(ts, cadence: Cadence = Cadence()) -> Column:
    """True on weekdays (Mon=0..Fri=4) with ``start <= local hour < end``."""
    if not cadence.enabled:
        return F.lit(False)
    local = local_time(ts, cadence.tz)
    h = F.hour(local)
    return (F.weekday(local) < 5) & (h >= cadence.start_hour) & (h < cadence.end_hour)


def effective_interval(ts, cadence: Cadence = Cadence(), base=None) -> Column:
    """Interval in seconds in force at ``ts``: ``int(base * multiplier)`` at night."""
    b = F.lit(cadence.base_seconds) if base is None else _c(base)
    slow = (b * F.lit(cadence.multiplier)).cast("int")
    return F.when(is_night(ts, cadence), slow).otherwise(b.cast("int"))
