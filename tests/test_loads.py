"""Loads that are cut differently, hold damaged rows, or are repeated."""
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapline.operators.change import changes_as_of
from snapline.operators.health import write_health
from snapline.operators.merge import partition_dirs, read_history
from snapline.operators.retention import drop_expired_paths
from snapline.plans.monitor import health_check
from snapline.spec import FeedSpec
from snapline.streaming.silver import load_batch, stored_schema
from snapline.streaming.sinks import publish

SPEC = FeedSpec(key=("k",), cycle="t", order=("seen",), compared=("v",), date_col="day", lookback_days=7,
                buckets=(86400,))
SCHEMA = "k string, t timestamp_ntz, v int, seen timestamp_ntz, day date"
START = datetime(2024, 1, 1)


def feed(spark, rows):
    return spark.createDataFrame([(k, t, v, START, t.date() if t else None) for k, t, v in rows], SCHEMA)


def fold(rows, days=7):
    out, last = set(), {}
    for k, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        p = last.get(k)
        if p is None or p[1] != v or p[0] < t - timedelta(days=days):
            out.add((k, t))
            last[k] = (t, v)
    return out


def stored(spark, path, like):
    return read_history(spark, path, stored_schema(like, SPEC), SPEC)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_of_the_feed_gives_the_same_rows(spark, tmp_path, seed):
    r = random.Random(seed)
    rows = sorted({(f"k{r.randint(0, 5)}", START + timedelta(hours=r.randint(0, 24 * 30))) for _ in range(150)}, key=lambda x: x[1])
    rows = [(k, t, int(r.random() < 0.25)) for k, t in rows]
    want = fold(rows)
    cuts = sorted(r.sample(range(1, len(rows)), 4))
    for name, parts in (("one", [rows]), ("many", [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])])):
        path = str(tmp_path / name)
        for i, part in enumerate(parts):
            load_batch(feed(spark, part), path, f"b{i:03d}", SPEC, typed=True)
        got = {(x["k"], x["t"]) for x in stored(spark, path, feed(spark, rows[:1])).collect()}
        assert got == want
    # A retry of a batch that was loaded in slices finds the same rows again.
    load_batch(feed(spark, rows), str(tmp_path / "one"), "b000", SPEC, typed=True)
    assert stored(spark, str(tmp_path / "one"), feed(spark, rows[:1])).count() == len(want)


def test_look_back_is_per_row(spark):
    hist = feed(spark, [("a", START + timedelta(days=1, hours=12), 1)])
    rows = feed(spark, [("z", START + timedelta(days=8), 1), ("a", START + timedelta(days=9), 1)])
    got = {(r["k"], r["t"]) for r in changes_as_of(rows, hist, SPEC).collect()}
    assert got == {("z", START + timedelta(days=8)), ("a", START + timedelta(days=9))}
    on_time = feed(spark, [("z", START + timedelta(days=8), 1), ("a", START + timedelta(days=8, hours=12), 1)])
    assert {r["k"] for r in changes_as_of(on_time, hist, SPEC).collect()} == {"z"}
    with pytest.raises(ValueError):
        changes_as_of(feed(spark, [("a", START, 1), ("a", START + timedelta(days=8), 1)]), hist, SPEC)


def test_rows_without_a_cycle(spark, tmp_path):
    path = str(tmp_path / "h")
    good = [("a", START, 1), ("a", START + timedelta(days=1), 1)]
    assert load_batch(feed(spark, [good[0], (None, None, None), ("a", None, 5)]), path, "b0", SPEC, typed=True) == 3
    assert load_batch(feed(spark, [good[1]]), path, "b1", SPEC, typed=True) == 0
    assert load_batch(feed(spark, [("b", None, 1), (None, None, None)]), path, "b2", SPEC, typed=True) == 2
    h = stored(spark, path, feed(spark, good))
    assert h.count() == 5 and h.where("t is null").count() == 4
    assert None in [v for v, _ in partition_dirs(spark, path, "day")]
    assert drop_expired_paths(spark, path, "day", date(2024, 6, 1), 10) == [START.date()]
    assert stored(spark, path, feed(spark, good)).count() == 4


def test_repeated_check_replaces_its_rows(spark, tmp_path):
    row = [(START, "c", "down", None, None, None, "{}", None, False)]
    df = spark.createDataFrame(row, "check_timestamp timestamp_ntz, component string, status string, latency_ms double, "
                                    "lag_seconds double, lag_messages long, details string, error_message string, night_mode_active boolean")
    p = str(tmp_path / "health")
    for check in ("one", "one", "two"):
        write_health(df, p, check)
    assert spark.read.parquet(p).count() == 2


def test_silent_topics_and_missing_checkpoints_are_down(spark, tmp_path):
    msgs = spark.createDataFrame([("live", 0, 4, START)], "topic string, partition int, offset long, timestamp timestamp_ntz")
    probes = spark.createDataFrame([(START, True, 3.0, 1, 2, -1, None)],
                                   "check_timestamp timestamp_ntz, reachable boolean, latency_ms double, broker_count int, "
                                   "topic_count int, controller_id int, error string")
    rows = health_check(spark, str(tmp_path / "none"), msgs, START + timedelta(seconds=30), topics=["live", "gone"], probes=probes)
    got = {r["component"]: r["status"] for r in rows.collect()}
    assert got == {"pyspark_live": "down", "pyspark_gone": "down", "producer_live": "healthy", "producer_gone": "down",
                   "kafka": "healthy", "kraft_controller": "down"}


def test_publish_to_text(spark, tmp_path):
    publish(spark.createDataFrame([('{"a":1}',), ('{"a":2}',)], "value string"), path=str(tmp_path / "out"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == ['{"a":1}', '{"a":2}']


def test_misplaced_objects_do_not_reach_the_history(spark, tmp_path):
    from snapline.operators.envelope import apply_types
    from snapline.schemas import RAW_JSON_OPTIONS, RAW_SCHEMA, RECORD_FIELDS
    from snapline.streaming.silver import silver_sink
    rows = spark.createDataFrame([(START, START, "ds", "s1"), (START, START, "ds", "s2"), (START, START, "ds", "s3")],
                                 "request_timestamp timestamp_ntz, kafka_timestamp timestamp_ntz, dataset_id string, stationcode string")
    for f in RAW_SCHEMA.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    names = F.create_map(*[F.lit(x) for x in ("s1", "file:/b/avail/2024/01/01/p.json", "s2", "file:/b/avail/2024/xx/01/p.json",
                                              "s3", "file:/b/other/2024/01/01/p.json")])
    rows = rows.withColumn("source_file", names[F.col("stationcode")])
    assert set(RECORD_FIELDS) <= set(rows.columns)
    sink = silver_sink(str(tmp_path / "h"), "r", prefix="avail/", quarantine=str(tmp_path / "q"))
    sink(rows, 0)
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "h")).select("stationcode").collect()] == ["s1"]
    held = spark.read.schema(RAW_SCHEMA).options(**RAW_JSON_OPTIONS).json(str(tmp_path / "q" / "misplaced"))
    assert [r[0] for r in held.select("stationcode").collect()] == ["s2"]
    assert apply_types(held).count() == 1


def test_a_turned_away_message_is_decoded_once(spark, tmp_path):
    from snapline.operators.envelope import decode_envelope
    from snapline.streaming.silver import accept
    good = '{"dataset_id":"ds","request_timestamp":"2024-01-01T00:00:00.000000","record":"{\\"stationcode\\":\\"s1\\",\\"capacity\\":3}"}'
    m = decode_envelope(spark.createDataFrame([(good, START), ("not json", START)], "value string, timestamp timestamp_ntz"))
    m = m.withColumn("insert_timestamp", F.lit(None).cast("timestamp_ntz"))
    kept = accept(m, "drop", None, "b0")
    try:
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan and plan.count("from_json") <= 2
        assert [r["stationcode"] for r in kept.collect()] == ["s1"]
    finally:
        m.unpersist()
    for i, policy in enumerate(("drop", "quarantine")):
        assert load_batch(m, str(tmp_path / policy), f"b{i}", on_malformed=policy, quarantine=str(tmp_path / "q")) == 1
        assert not m.storageLevel.useMemory
    assert spark.read.text(str(tmp_path / "q")).count() == 1


def test_events_are_dealt_out_before_they_are_widened(spark, monkeypatch):
    from snapline.plans import derived
    from tests.conftest import SF_SMALL
    whole = derived.avail(spark, SF_SMALL)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(derived, "SPREAD_BYTES", 4096)
    dealt = derived.avail(spark, SF_SMALL)
    assert dealt.rdd.getNumPartitions() == -(-derived.input_bytes(spark, SF_SMALL) // 4096) > 1
    assert dealt.exceptAll(whole).count() == 0 and dealt.count() == whole.count()
