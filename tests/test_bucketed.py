import re
from datetime import datetime, timedelta

from snapline.operators.bucketed import merge_bucketed, new_rows, open_bucketed
from snapline.operators.merge import history_schema
from test_merge import SPEC, rows

T0 = datetime(2024, 1, 1, 23, 59, 50)


def feed(spark, n, first=0):
    """Every third row belongs to one key; the rows span midnight."""
    return rows(spark, [("hot" if i % 3 == 0 else f"k{i % 7}", T0 + timedelta(seconds=i), T0, i)
                        for i in range(first, first + n)])


def stored(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_merge_meets_the_stored_buckets_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "h")
    df = feed(spark, 60)
    schema = history_schema(df.schema, SPEC)
    open_bucketed(spark, "bucketed_a", path, schema, SPEC, 4)
    assert merge_bucketed(df, "bucketed_a", SPEC, "b0") == 60
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = new_rows(feed(spark, 60, 40), "bucketed_a", SPEC, "b1")
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in plan.splitlines() if "Exchange" in line]
        # The batch's own, on the left of the join and into as many parts as there are buckets.
        assert len(shuffles) == 1 and shuffles[0].lstrip().startswith(":"), plan
        assert re.search(r"hashpartitioning\(k#\d+, c#\d+, 4\)", shuffles[0]), plan
        assert "SelectedBucketsCount: 4 out of 4" in plan
        assert sorted(r["v"] for r in fresh.collect()) == list(range(60, 100))
        assert merge_bucketed(feed(spark, 60, 40), "bucketed_a", SPEC, "b1") == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # The hot key's rows lie in every bucket.
    files = spark.table("bucketed_a").where("k = 'hot'").selectExpr("input_file_name() f").distinct().collect()
    assert len({r["f"].rsplit("_", 1)[1].split(".")[0] for r in files}) == 4


def test_retries_and_a_new_session_see_each_row_once(spark, tmp_path):
    path = str(tmp_path / "h")
    df = feed(spark, 30)
    schema = history_schema(df.schema, SPEC)
    open_bucketed(spark, "bucketed_b", path, schema, SPEC, 4)
    assert merge_bucketed(df, "bucketed_b", SPEC, "b0") == 30
    assert merge_bucketed(df, "bucketed_b", SPEC, "b0") == 30       # replaces its own folders
    assert merge_bucketed(df, "bucketed_b", SPEC, "b1") == 0
    assert merge_bucketed(df.limit(0), "bucketed_b", SPEC, "b2") == 0
    before = stored(spark, "bucketed_b")
    assert len(before) == 30
    # Another catalog entry over the same files, as a later session opens them.
    open_bucketed(spark, "bucketed_c", path, schema, SPEC, 4)
    assert stored(spark, "bucketed_c") == before
    assert merge_bucketed(feed(spark, 40), "bucketed_c", SPEC, "b3") == 10


def test_rows_without_key_or_cycle_are_always_new(spark, tmp_path):
    odd = rows(spark, [(None, T0, T0, 1), ("a", None, T0, 2), ("a", T0, T0, 3)])
    open_bucketed(spark, "bucketed_d", str(tmp_path / "h"), history_schema(odd.schema, SPEC), SPEC, 2)
    assert merge_bucketed(odd, "bucketed_d", SPEC, "b0") == 3
    assert merge_bucketed(odd, "bucketed_d", SPEC, "b1") == 2
    assert len(stored_rows := spark.table("bucketed_d").collect()) == 5
    assert sum(r["d"] is None for r in stored_rows) == 2
