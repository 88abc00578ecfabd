"""snapline — snapshot feeds to change history, on Spark DataFrames and Structured Streaming.

Every operator is ``DataFrame -> DataFrame`` built from ``pyspark.sql.functions``;
timestamps are UTC wall-clock ``timestamp_ntz`` (the session time zone must be UTC,
see :func:`snapline.session.get_session`).
"""

from snapline.spec import FeedSpec, STATION_SPEC

__all__ = ["FeedSpec", "STATION_SPEC"]
