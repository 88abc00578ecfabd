"""The command-line jobs end to end: landed messages -> bronze -> silver -> verify."""
import json
import os
import subprocess
import sys

from snapline.plans.derived import landed_messages
from snapline.schemas import RAW_JSON_OPTIONS
from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def cli(*args):
    out = subprocess.run([sys.executable, "-m", "snapline.cli", "--master", "local[4]", *args],
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    assert out.returncode == 0, out.stderr[-2000:]
    return [json.loads(l) for l in out.stdout.splitlines() if l.startswith("{")]


def test_bronze_silver_verify(spark, tmp_path):
    msgs = str(tmp_path / "msgs")
    landed_messages(spark, SF_SMALL).write.options(**RAW_JSON_OPTIONS).json(msgs)
    cli("bronze", "--source", "files", "--path", msgs, "--raw-base", str(tmp_path / "raw"),
        "--checkpoint", str(tmp_path / "ck-b"), "--run-id", "b1", "--once")
    raw_glob = str(tmp_path / "raw" / "availability" / "*" / "*" / "*" / "*")
    cli("silver", "--raw-glob", raw_glob, "--history", str(tmp_path / "hist"),
        "--checkpoint", str(tmp_path / "ck-s"), "--run-id", "s1", "--lookback-days", "-1", "--once",
        "--metrics", str(tmp_path / "metrics"), "--state", str(tmp_path / "state"))
    from snapline.streaming.metrics import read_metrics
    from snapline.streaming.snapshots import snapshots
    told = read_metrics(spark, str(tmp_path / "metrics")).collect()
    assert sum(r["inserted"] for r in told) == 667 and {r["run_id"] for r in told} == {"s1"}
    assert snapshots(spark, str(tmp_path / "state"), None)
    (v,) = cli("verify", "--history", str(tmp_path / "hist"), "--raw-glob", raw_glob)
    assert v["duplicates"] == 0
    assert v["history_rows"] == 667 and v["keys"] == 15
    assert v["n_snapshot_rows"] == 951


def test_health_job(spark, tmp_path):
    from pyspark.sql import functions as F
    # a Kafka-shaped checkpoint: batch 0 and 1 of topic "view", partitions 0..2
    off = tmp_path / "ck" / "offsets"
    off.mkdir(parents=True)
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":0,"conf":{}}'
    (off / "0").write_text(f'v1\n{meta}\n{{"view":{{"0":10,"1":10,"2":10}}}}')
    (off / "1").write_text(f'v1\n{meta}\n{{"view":{{"0":400,"1":400,"2":400}}}}')
    msgs = str(tmp_path / "msgs")
    landed_messages(spark, SF_SMALL).filter(F.col("topic") == "view").write.options(**RAW_JSON_OPTIONS).json(msgs)
    rows = cli("health", "--checkpoint", str(tmp_path / "ck"), "--messages", msgs,
               "--health-table", str(tmp_path / "health"), "--as-of", "2024-01-15T12:00:00")
    comps = {r["component"]: r for r in rows}
    assert set(comps) == {"pyspark_view", "producer_view"}
    assert comps["pyspark_view"]["lag_messages"] is not None
    assert comps["producer_view"]["status"] in ("healthy", "degraded", "down")
    assert spark.read.parquet(str(tmp_path / "health")).count() == 2
