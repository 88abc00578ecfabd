from datetime import datetime, timedelta

from pyspark.sql import functions as F

from snapline.operators.change import changes_as_of, changes_sequential, changes_vs_state
from snapline.operators.dedup import dedup_earliest
from snapline.operators.state import last_known
from snapline.spec import FeedSpec

SPEC = FeedSpec(key=("k",), cycle="c", order=("b",), compared=("v", "f"), static=("name",),
                date_col="d", lookback_days=7)
SCHEMA = "k string, c timestamp_ntz, b timestamp_ntz, v int, f boolean, name string"
T0 = datetime(2024, 1, 10)


def rows(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    return df.withColumn("d", F.to_date("c"))


def h(n):
    return T0 + timedelta(hours=n)


def c1(spark, hist, batch):
    st = last_known(hist, SPEC, as_of=h(0), before=batch.agg(F.min("c")).first()[0])
    return changes_vs_state(batch, st, SPEC)


def test_earliest_copy(spark):
    df = rows(spark, [("a", h(1), h(3), 1, True, "x"), ("a", h(1), h(1), 2, True, "y"),
                      ("a", h(1), h(2), 3, True, "z"), ("a", h(1), None, 4, True, "w")])
    got = dedup_earliest(df, ["k", "c"], ["b"]).collect()
    assert len(got) == 1 and got[0]["v"] == 4  # NULL broker time sorts first


def test_batch_BB_after_A(spark):
    hist = rows(spark, [("a", h(0), h(0), 1, True, "n")])
    batch = rows(spark, [("a", h(1), h(1), 2, True, "n"), ("a", h(2), h(2), 2, True, "n")])
    assert c1(spark, hist, batch).count() == 2
    assert changes_as_of(batch, hist, SPEC).count() == 1


def test_batch_BA_after_A(spark):
    hist = rows(spark, [("a", h(0), h(0), 1, True, "n")])
    batch = rows(spark, [("a", h(1), h(1), 2, True, "n"), ("a", h(2), h(2), 1, True, "n")])
    assert c1(spark, hist, batch).count() == 1     # the return to A is lost
    assert changes_as_of(batch, hist, SPEC).count() == 2


def test_null_safe_and_name_only(spark):
    df = rows(spark, [("a", h(0), h(0), None, None, "n"), ("a", h(1), h(1), None, None, "n"),
                      ("a", h(2), h(2), None, True, "n"), ("a", h(3), h(3), None, True, "renamed")])
    got = [r["c"] for r in changes_sequential(df, SPEC).orderBy("c").collect()]
    assert got == [h(0), h(2)]


def test_null_keys_always_kept(spark):
    df = rows(spark, [(None, h(0), h(0), 1, True, "n"), (None, h(1), h(1), 1, True, "n")])
    assert changes_sequential(df, SPEC).count() == 2
    hist = df
    batch = rows(spark, [(None, h(2), h(2), 1, True, "n")])
    assert changes_as_of(batch, hist, SPEC).count() == 1


def test_lookback_boundary(spark):
    hist = rows(spark, [("a", T0, T0, 1, True, "n")])
    exact = rows(spark, [("a", T0 + timedelta(days=7), T0, 1, True, "n")])
    older = rows(spark, [("a", T0 + timedelta(days=7, microseconds=1), T0, 1, True, "n")])
    assert changes_as_of(exact, hist, SPEC).count() == 0       # still known
    assert changes_as_of(older, hist, SPEC).count() == 1       # re-emitted


def test_replay_inserts_nothing(spark):
    data = [("a", h(i), h(i), v, True, "n") for i, v in enumerate([1, 1, 2, 2, 1, 3])]
    allrows = rows(spark, data)
    kept = changes_sequential(allrows, SPEC)
    assert kept.count() == 4
    assert changes_as_of(allrows, kept, SPEC).count() == 0
    assert changes_as_of(rows(spark, data[2:4]), kept, SPEC).count() == 0


def test_late_row_compared_with_predecessor(spark):
    hist = rows(spark, [("a", h(0), h(0), 1, True, "n"), ("a", h(4), h(4), 2, True, "n")])
    late = rows(spark, [("a", h(2), h(5), 1, True, "n")])
    assert changes_as_of(late, hist, SPEC).count() == 0    # equals its predecessor at h0
    st = last_known(hist, SPEC, as_of=h(0))
    assert changes_vs_state(late, st, SPEC).count() == 1   # C1 compares with the newest (h4)
