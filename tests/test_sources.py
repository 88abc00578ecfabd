from datetime import datetime

from snapline.operators.health import write_health
from snapline.plans.derived import landed_messages
from snapline.schemas import RAW_JSON_OPTIONS
from snapline.sources.feed import broker_summary, kafka_options, open_feed, topic_watermarks
from snapline.sources.raw import route_objects
from snapline.streaming.jobs import bronze_dedup, run_available
from tests.conftest import SF_SMALL


def test_kafka_options():
    o = kafka_options("b:9092", "t", starting="earliest", max_offsets_per_trigger=1000)
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["maxOffsetsPerTrigger"] == "1000" and o["subscribe"] == "t"


def test_file_feed_and_watermarks(spark, tmp_path):
    m = landed_messages(spark, SF_SMALL)
    m.write.options(**RAW_JSON_OPTIONS).json(str(tmp_path / "msgs"))
    feed = open_feed(spark, "files", path=str(tmp_path / "msgs"), options=RAW_JSON_OPTIONS, streaming=False)
    assert feed.count() == m.count()
    wm = topic_watermarks(feed)
    assert wm.count() == 15  # 5 topics x 3 partitions
    s = broker_summary(wm).first()
    assert (s["topic_count"], s["partition_count"]) == (5, 15)
    exact = feed.exceptAll(m.select(*feed.columns)).count()
    assert exact == 0  # timestamps survive the JSON round trip to the microsecond


def test_route_objects(spark):
    names = ["avail/2024/01/05/epoch-1.json", "avail/2024/01/05/epoch-1.txt", "other/2024/01/05/e.json",
             "avail/2024/01/e.json", "avail/a/b/c/e.json"]
    df = route_objects(spark.createDataFrame([(n,) for n in names], "n string"), "n", "avail/")
    got = [(r["route"], r["batch_date"]) for r in df.collect()]
    assert [g[0] for g in got] == ["accepted", "ignored", "ignored", "quarantined", "quarantined"]
    assert str(got[0][1]) == "2024-01-05"


def test_write_health_layout(spark, tmp_path):
    from snapline.plans.catalog import health_table
    h = health_table(spark, SF_SMALL)
    write_health(h, str(tmp_path / "health"), "one")
    back = spark.read.parquet(str(tmp_path / "health"))
    assert back.count() == h.count()
    assert "check_date" in back.columns


def test_bronze_dedup_within_watermark(spark, tmp_path):
    rows = [("a", datetime(2024, 1, 1, 10), 1), ("a", datetime(2024, 1, 1, 10), 2),
            ("b", datetime(2024, 1, 1, 10), 3)]
    spark.createDataFrame(rows, "k string, t timestamp, v int").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("k string, t timestamp, v int").parquet(str(tmp_path / "in"))
    d = bronze_dedup(s, ["k", "t"], "t", "1 hour")
    run_available(d, "parquet", str(tmp_path / "ck"), path=str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_raw_sink_skips_empty_and_stamps(spark, tmp_path):
    import os

    from snapline.plans.derived import avail
    from snapline.sources.raw import read_raw
    from snapline.streaming.sinks import raw_sink
    write = raw_sink(str(tmp_path / "raw"), "t", "run", clock=lambda: datetime(2024, 2, 1, 12))
    a = avail(spark, SF_SMALL).drop("insert_timestamp")
    write(a.limit(0), 0)
    assert not os.path.exists(tmp_path / "raw")
    write(a, 1)
    back = read_raw(spark, str(tmp_path / "raw" / "t" / "2024" / "02" / "01" / "run-epoch-1"))
    assert back.count() == a.count()
    assert back.select("insert_timestamp").distinct().first()[0] == datetime(2024, 2, 1, 12)
