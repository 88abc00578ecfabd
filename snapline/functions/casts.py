"""Typing rules of the feed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the text that means "true" in the feed's flags (exact, case-sensitive).
TRUE_TEXT = "OUI"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(c) -> Column:
    """``'OUI'`` -> true, anything else -> false, NULL stays NULL (three-valued)."""
    return _c(c) == F.lit(TRUE_TEXT)


def to_ntz(c) -> Column:
    """Instant -> UTC wall-clock ``timestamp_ntz`` (session time zone is UTC)."""
    return _c(c).cast("timestamp_ntz")


def text_timestamp(c) -> Column:
    """Lenient ISO-8601 text -> UTC wall clock; unparsable or empty text -> NULL.

    Offsets are honoured (``+02:00`` is shifted to UTC), text without a zone is read
    as UTC, a bare date is midnight. ``try_to_timestamp`` keeps ANSI mode on without
    raising on bad text.
    """
    return to_ntz(F.try_to_timestamp(_c(c)))


def cycle_date(c) -> Column:
    """Partition date of a UTC wall-clock timestamp."""
    return F.to_date(_c(c))
