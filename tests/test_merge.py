from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from snapline.operators.change import history_window
from snapline.operators.merge import insert_only, read_history, write_history, history_schema
from snapline.spec import FeedSpec

SPEC = FeedSpec(key=("k",), cycle="c", order=("b",), compared=("v",), date_col="d")
SCHEMA = "k string, c timestamp_ntz, b timestamp_ntz, v int"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("d", F.to_date("c"))


def test_write_is_replay_safe(spark, tmp_path):
    path = str(tmp_path / "hist")
    t = datetime(2024, 1, 1, 23, 59, 50)
    df = rows(spark, [("a", t, t, 1), ("b", t + timedelta(seconds=20), t, 2)])  # spans midnight
    assert write_history(df, path, SPEC, "run-000001", as_of=t, stamp_col=None) == 2
    assert write_history(df, path, SPEC, "run-000001", as_of=t, stamp_col=None) == 2  # retry overwrites
    schema = history_schema(df.schema, SPEC)
    h = read_history(spark, path, schema, SPEC)
    assert h.count() == 2
    assert sorted(r[0] for r in h.select("d").distinct().collect()) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert read_history(spark, path, schema, SPEC, exclude_batch="run-000001").count() == 0
    again = insert_only(df, h, SPEC, dates=[date(2024, 1, 1), date(2024, 1, 2)])
    assert again.count() == 0


def test_history_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "hist")
    base = datetime(2024, 1, 1)
    df = rows(spark, [("a", base + timedelta(days=i), base, i) for i in range(20)])
    write_history(df, path, SPEC, "r-0", stamp_col=None)
    h = read_history(spark, path, history_schema(df.schema, SPEC), SPEC)
    w = history_window(h, SPEC, base + timedelta(days=15), base + timedelta(days=16), 7)
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "isnotnull(d" in plan
    assert w.count() == 9  # days 8..16


def test_compact_and_expire(spark, tmp_path):
    from snapline.operators.merge import compact_dates, partition_dirs
    from snapline.operators.retention import drop_expired_paths
    path = str(tmp_path / "hist")
    base = datetime(2024, 1, 1, 1)
    for b in range(3):  # three batches on the same two days
        df = rows(spark, [(f"k{i}", base + timedelta(hours=b, days=i % 2), base, i) for i in range(6)])
        write_history(df, path, SPEC, f"run-{b}", stamp_col=None)
    schema = history_schema(df.schema, SPEC)
    before = sorted(read_history(spark, path, schema, SPEC).drop("batch_id").collect())
    assert compact_dates(spark, path, schema, SPEC, [date(2024, 1, 1)]) == 9
    assert [v for v, _ in partition_dirs(spark, f"{path}/d=2024-01-01", "batch_id")] == ["compact"]
    assert compact_dates(spark, path, schema, SPEC, [date(2024, 1, 1)]) == 9  # idempotent
    after = sorted(read_history(spark, path, schema, SPEC).drop("batch_id").collect())
    assert after == before[:0] + sorted(set(before))
    assert drop_expired_paths(spark, path, "d", date(2024, 1, 3), 1) == [date(2024, 1, 1)]
    assert read_history(spark, path, schema, SPEC).count() == 9


def test_a_write_leaves_a_file_per_date_not_per_shuffle_partition(spark, tmp_path):
    path = str(tmp_path / "hist")
    base = datetime(2024, 1, 1)
    df = rows(spark, [(f"k{i}", base + timedelta(hours=i % 72), base, i) for i in range(600)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_history(df, path, SPEC, "r-0", stamp_col=None) == 600
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = list((tmp_path / "hist").glob("d=*/batch_id=r-0/*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 3
    kept = read_history(spark, path, history_schema(df.schema, SPEC), SPEC)
    assert kept.drop("batch_id").select(*df.columns).exceptAll(df).count() == 0 and kept.count() == 600
