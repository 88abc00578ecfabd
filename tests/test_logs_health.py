from datetime import datetime

from snapline.operators.health import stream_health
from snapline.session import cluster_conf
from snapline.sources.logs import checkpoint_offsets, kafka_partition_offsets, latest_batch


def test_kafka_checkpoint_offsets(spark, tmp_path):
    off = tmp_path / "ck" / "offsets"
    off.mkdir(parents=True)
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":1700000000000,"conf":{}}'
    (off / "0").write_text(f'v1\n{meta}\n{{"avail":{{"0":12,"1":30}}}}')
    (off / "1").write_text(f'v1\n{meta}\n{{"avail":{{"0":20,"1":41}}}}')
    (off / ".1.crc").write_text("x")
    o = checkpoint_offsets(spark, str(tmp_path / "ck"))
    assert o.count() == 2
    parts = {(r["batch_id"], r["partition"]): r["offset"] for r in kafka_partition_offsets(o).collect()}
    assert parts == {(0, "0"): 12, (0, "1"): 30, (1, "0"): 20, (1, "1"): 41}
    assert latest_batch(o).first()["batch_id"] == 1


def test_stream_health_unknown_high_and_no_commit(spark):
    t = datetime(2024, 1, 1, 12)
    rows = [(t, "s", 0, 10, 15, datetime(2024, 1, 1, 11, 59)), (t, "s", 1, 5, None, datetime(2024, 1, 1, 11, 58)),
            (t, "q", 0, None, 7, None)]
    df = spark.createDataFrame(rows, "check_timestamp timestamp_ntz, stream string, partition int, "
                                     "committed long, high long, commit_time timestamp_ntz")
    h = {r["component"]: r for r in stream_health(df, 120).collect()}
    assert h["pyspark_s"]["status"] == "healthy" and h["pyspark_s"]["lag_messages"] is None
    assert h["pyspark_s"]["lag_seconds"] == 60.0
    assert h["pyspark_q"]["status"] == "down" and h["pyspark_q"]["error_message"].startswith("stream has committed nothing")


def test_cluster_conf():
    c = cluster_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(cluster_conf(10**6, 64)["spark.sql.shuffle.partitions"]) == 128


def test_drop_expired_partitions(spark, tmp_path):
    from datetime import date

    from pyspark.sql import functions as F

    from snapline.operators.retention import drop_expired, expired_partitions
    df = spark.range(10).select(F.date_add(F.lit(date(2024, 1, 1)), F.col("id").cast("int")).alias("d"), "id")
    df.write.partitionBy("d").option("path", str(tmp_path / "h")).saveAsTable("retention_probe")
    try:
        listed = expired_partitions(spark.table("retention_probe"), "d", date(2024, 1, 10), 3)
        assert listed.filter("expired").count() == 6
        assert len(drop_expired(spark, "retention_probe", "d", date(2024, 1, 10), 3)) == 6
        assert spark.sql("SHOW PARTITIONS retention_probe").count() == 4
    finally:
        spark.sql("DROP TABLE IF EXISTS retention_probe")
