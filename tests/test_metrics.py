"""One row of metrics per micro-batch, under a processing-time trigger."""
import time
from types import SimpleNamespace

from snapline.plans.streams import _silver, files_per_day, land_raw_days, raw_stream
from snapline.streaming.jobs import start
from snapline.streaming.metrics import RunMetrics, read_metrics
from snapline.streaming.silver import silver_sink
from tests.conftest import SF_SMALL


def test_rows_per_batch(spark, tmp_path):
    raw, out, path = str(tmp_path / "raw"), str(tmp_path / "silver"), str(tmp_path / "metrics")
    land_raw_days(spark, SF_SMALL, raw)
    listener = RunMetrics(spark, "metered", path, "r1")
    spark.streams.addListener(listener)
    try:
        q = start(raw_stream(spark, raw, 10 * files_per_day(spark, SF_SMALL)),
                  silver_sink(out, "r1", lookback_days=None, metrics=listener), str(tmp_path / "ck"), name="metered",
                  trigger={"processingTime": "1 second"})
        try:
            q.processAllAvailable()
            listener.wait(q)
            time.sleep(2.5)                         # triggers without data write nothing
        finally:
            q.stop()
    finally:
        spark.streams.removeListener(listener)
    rows = {r["batch_id"]: r for r in read_metrics(spark, path).collect()}
    held = {r["batch_id"]: r["count"] for r in _silver(spark, out).groupBy("batch_id").count().collect()}
    assert len(rows) >= 3 and sorted(rows) == list(range(len(rows)))
    assert {f"r1-{b:06d}": r["inserted"] for b, r in rows.items() if r["inserted"]} == held
    assert all(r["duration_ms"] > 0 and r["run_id"] == "r1" and r["rows_in"] > 0 for r in rows.values())
    assert sum(r["rows_in"] for r in rows.values()) == spark.read.json(f"{raw}/*").count()
    # A batch that runs again overwrites its row; other queries' batches write none.
    def event(name):
        return SimpleNamespace(progress=SimpleNamespace(name=name, numInputRows=5, batchId=0, batchDuration=7, timestamp="t"))
    listener.append((0, 3))
    listener.onQueryProgress(event("metered"))
    listener.onQueryProgress(event("other"))
    again = {r["batch_id"]: r for r in read_metrics(spark, path).collect()}
    assert len(again) == len(rows) and (again[0]["rows_in"], again[0]["inserted"]) == (5, 3)
