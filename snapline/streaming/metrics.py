"""Run metrics of a stream: one row per micro-batch."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from snapline.operators.merge import _fs

METRICS_SCHEMA = "run_id string, batch_id long, rows_in long, inserted long, duration_ms long, started_at string"


class RunMetrics(StreamingQueryListener):
    """Writes ``<path>/<run_id>-<batch>.json`` for every micro-batch of the query named ``name``:
    rows read from the source, rows inserted, duration and start.

    Give it to ``silver_sink(metrics=...)`` as well: the sink tells it each batch's inserted rows
    before the batch commits; sinks that tell nothing leave them null. A batch that is run again
    overwrites its file. Progress without a batch (a trigger that found no data) writes nothing.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, run_id: str):
        self._spark, self._name, self._path, self._run = spark, name, path.rstrip("/"), run_id
        self._inserted: dict[int, int] = {}
        self.written = -1                          # newest batch on file

    def append(self, row: tuple[int, int]) -> None:
        self._inserted[row[0]] = row[1]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self._name or (p.numInputRows == 0 and p.batchId not in self._inserted):
            return
        row = {"run_id": self._run, "batch_id": p.batchId, "rows_in": p.numInputRows,
               "inserted": self._inserted.pop(p.batchId, None), "duration_ms": p.batchDuration,
               "started_at": p.timestamp}
        fs, file = _fs(self._spark, f"{self._path}/{self._run}-{p.batchId:06d}.json")
        out = fs.create(file, True)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()
        self.written = max(self.written, p.batchId)

    def wait(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Events arrive a little after their batch: wait until the last batch with rows is on file."""
        last = max((p.batchId for p in query.recentProgress if p.numInputRows), default=-1)
        end = time.monotonic() + seconds
        while self.written < last:
            if time.monotonic() > end:
                raise TimeoutError(f"no progress of batch {last} within {seconds} s")
            time.sleep(0.05)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table, all runs."""
    return spark.read.schema(METRICS_SCHEMA).json(path)
