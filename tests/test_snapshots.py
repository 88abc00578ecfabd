"""State snapshots: the same rows as loads that open the whole look-back, from less input."""
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapline.operators.merge import read_history
from snapline.streaming.silver import load_batch, stored_schema
from snapline.streaming.snapshots import drop_snapshots, known_rows, snapshots, take_snapshot
from tests.test_loads import SPEC, START, feed, fold, stored


def rows_of(seed, days=16):
    r = random.Random(seed)
    times = [START + timedelta(hours=h) for h in range(0, 24 * days, 6)]
    # One key changes often, one seldom, one goes silent for longer than the look-back; one is null.
    return [(k, t, r.choice(v)) for k, v in (("a", [1, 2, None]), ("b", [1]), ("c", [1, 1, 1, 2]))
            for t in times if not (k == "c" and 3 <= (t - START).days < 12)] + [(None, START, 1)]


def got(spark, path, df):
    return sorted((str(r["k"]), r["t"]) for r in stored(spark, path, df).select("k", "t").collect())


@pytest.mark.parametrize("mode", ["asof", "faithful"])
def test_same_rows_with_and_without(spark, tmp_path, mode):
    rows = rows_of(3)
    df = feed(spark, rows)
    cuts = [0, 2, 3, 9, 12, 16]
    batches = [(START + timedelta(days=a), START + timedelta(days=b)) for a, b in zip(cuts, cuts[1:])]
    order = [0, 1, 2, 2, 4, 3, 1]                           # a retry, a late batch and a replay
    for state in (None, str(tmp_path / "state")):
        path = str(tmp_path / ("plain" if state is None else "snapped"))
        for i in order:
            lo, hi = batches[i]
            load_batch(df.filter((F.col("t") >= F.lit(lo)) & (F.col("t") < F.lit(hi))), path, f"b{i}", SPEC, mode=mode,
                       typed=True, state=state)
    assert got(spark, str(tmp_path / "snapped"), df) == got(spark, str(tmp_path / "plain"), df)


def test_in_order_equals_the_fold_and_reads_less(spark, tmp_path):
    rows = [r for r in rows_of(5) if r[0] is not None]
    df, path, state = feed(spark, rows), str(tmp_path / "h"), str(tmp_path / "s")
    for d in range(0, 16, 4):
        lo, hi = START + timedelta(days=d), START + timedelta(days=d + 4)
        load_batch(df.filter((F.col("t") >= F.lit(lo)) & (F.col("t") < F.lit(hi))), path, f"b{d}", SPEC, typed=True, state=state)
    assert {(k, t) for k, t in got(spark, path, df)} == {(k, t) for k, t in fold(rows)}
    have = snapshots(spark, state, 7)
    assert [d for d, _ in have] == [date(2024, 1, 7), date(2024, 1, 11), date(2024, 1, 15)]     # the three newest
    # Key c was silent for more than the look-back: the snapshot of the 11th has left it out.
    assert {r["k"] for r in spark.read.parquet(have[1][1]).collect()} == {"a", "b"}
    schema = stored_schema(df, SPEC)
    at = START + timedelta(days=16)
    few = known_rows(spark, path, schema, SPEC, state, 7, at=at)
    many = known_rows(spark, path, schema, SPEC, None, 7, at=at)
    days = {f.split("day=")[1][:10] for f in few.inputFiles() if "day=" in f}
    assert days == {"2024-01-16"} and len({f.split("day=")[1][:10] for f in many.inputFiles()}) > 3

    def newest(d):
        return sorted(d.filter(F.col("t") >= F.lit(at - timedelta(days=7))).groupBy("k").agg(F.max("t")).collect())
    assert newest(few) == newest(many)


def test_snapshots_end_where_days_change(spark, tmp_path):
    df, path, state = feed(spark, rows_of(7)), str(tmp_path / "h"), str(tmp_path / "s")
    schema = stored_schema(df, SPEC)
    assert not snapshots(spark, state, 7)
    assert read_history(spark, path, schema, SPEC).count() == 0
    load_batch(df, path, "b", SPEC, typed=True, state=state)
    assert [d for d, _ in snapshots(spark, state, 7)] == [date(2024, 1, 15)]
    assert not take_snapshot(spark, path, schema, SPEC, state, 7, date(2024, 1, 15))
    assert take_snapshot(spark, path, schema, SPEC, state, 7, date(2024, 1, 9))
    drop_snapshots(spark, state, 7, date(2024, 1, 10))
    assert [d for d, _ in snapshots(spark, state, 7)] == [date(2024, 1, 9)]
    assert not snapshots(spark, state, None)                # another look-back, another folder
    load_batch(df.limit(0), path, "empty", SPEC, typed=True, state=state)
    assert [d for d, _ in snapshots(spark, state, 7)] == [date(2024, 1, 9)]
    load_batch(feed(spark, [("n", None, 1)]), path, "undated", SPEC, typed=True, state=state)
    assert datetime(2024, 1, 9).date() == snapshots(spark, state, 7)[0][0]
