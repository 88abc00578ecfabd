"""Text encodings: ISO timestamps, JSON, object paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed formats: ISO-8601 with microseconds and a numeric offset, and the
# year/month/day object folder.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
DATE_PATH_PATTERN = "yyyy/MM/dd"

JSON_OPTIONS = {"ignoreNullFields": "false"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_text(c) -> Column:
    """UTC wall-clock timestamp -> ``2024-01-05T10:00:00.123456+00:00`` (keeps micros)."""
    return F.date_format(_c(c), ISO_PATTERN)


def date_path(c) -> Column:
    """Timestamp -> ``YYYY/MM/DD`` folder."""
    return F.date_format(_c(c), DATE_PATH_PATTERN)


def json_text(c) -> Column:
    """Struct -> JSON text with explicit nulls (non-ASCII kept)."""
    return F.to_json(_c(c), JSON_OPTIONS)


def path_parts(c) -> Column:
    """Object name -> array of ``/``-separated parts."""
    return F.split(_c(c), "/")
