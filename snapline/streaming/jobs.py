"""Starting streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the micro-batch period of the bronze job.
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


def start(df: DataFrame, sink: Callable[[DataFrame, int], None] | str, checkpoint: str, *,
          name: str | None = None, trigger: dict | None = None, path: str | None = None,
          options: dict | None = None) -> StreamingQuery:
    """Start ``df`` into a ``foreachBatch`` callable or a format name (``"json"``,
    ``"parquet"``, ``"memory"``...), append mode, one checkpoint folder per stream.
    Restarting on the same checkpoint resumes after the last committed batch."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or DEFAULT_TRIGGER))
    if options:
        w = w.options(**options)
    if callable(sink):
        return w.foreachBatch(sink).start()
    w = w.format(sink)
    return w.start(path) if path else w.start()


def run_available(df: DataFrame, sink, checkpoint: str, **kw) -> StreamingQuery:
    """Process everything available now in bounded batches, then stop (tests, backfills)."""
    q = start(df, sink, checkpoint, trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def bronze_dedup(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """T8 option for the raw layer: drop copies of a key seen within the watermark
    delay (keeps the first *arrived* copy; the silver load still picks the earliest
    broker time)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
