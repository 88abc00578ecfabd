"""Greedy selection by a gap, the gap cadence and the one-pass change filter, against row-by-row walks."""
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapline.functions.cadence import Cadence
from snapline.operators.cadence import thin_by_gap
from snapline.operators.change import changes_in_one_pass
from snapline.operators.spacing import spaced
from tests.test_loads import SPEC, START, feed, fold


def walk(rows, gap):
    out, due = set(), {}
    for k, t in sorted(set(rows), key=lambda r: (str(r[0]), r[1])):
        if k not in due or t >= due[k]:
            out.add((k, t))
            due[k] = t + gap(t)
    return out


@pytest.mark.parametrize("block_hours", [6, 100])
def test_spaced_equals_the_walk_with_a_hot_key(spark, block_hours):
    r = random.Random(block_hours)
    keys = ["hot"] * 6 + ["a", "b", "c", None, "d", "e"]
    rows = [(r.choice(keys), START + timedelta(minutes=r.randint(0, 60 * 24 * 12))) for _ in range(1500)]
    rows += [("hot", START + timedelta(days=90))]                     # a long silence
    df = spark.createDataFrame([*rows, ("a", None)], "k string, t timestamp_ntz")
    got = spaced(df, ["k"], "t", F.col("t") + F.expr("INTERVAL 5 HOURS"), block_seconds=block_hours * 3600)
    assert got.schema["t"].dataType == df.schema["t"].dataType
    got = [(x["k"], x["t"]) for x in got.collect()]
    assert len(got) == len(set(got)) and set(got) == walk(rows, lambda t: timedelta(hours=5))
    assert spaced(df.limit(0), ["k"], "t", F.col("t"), block_seconds=60).collect() == []


def test_gap_cadence_counts_from_the_kept_row(spark):
    c = Cadence(base_seconds=3600)
    night = datetime(2024, 1, 3, 1, 30)                               # 02:30 in Paris, a Wednesday
    rows = [("a", night + timedelta(minutes=m), m) for m in (0, 61, 239, 240, 241, 299, 300)]
    rows += [("a", night, -1)]                                        # a second copy: the smaller one stays
    got = thin_by_gap(spark.createDataFrame(rows, "k string, t timestamp_ntz, v int"), ["k"], "t", c).collect()
    assert sorted((x["t"], x["v"], x["night"], x["interval_seconds"]) for x in got) == [
        (night, -1, True, 14400), (night + timedelta(minutes=240), 240, False, 3600),
        (night + timedelta(minutes=300), 300, False, 3600)]


@pytest.mark.parametrize("seed", [3, 4])
def test_one_pass_equals_the_fold_over_a_long_backlog(spark, seed):
    r = random.Random(seed)
    times = sorted({(r.choice(["hot", "hot", "a", "b", "c"]), START + timedelta(hours=r.randint(0, 24 * 120))) for _ in range(300)},
                   key=lambda x: x[1])
    rows = [(k, t, int(r.random() < 0.04)) for k, t in times]
    want = fold(rows)
    cut = len(rows) // 3
    first = changes_in_one_pass(feed(spark, rows[:cut]), feed(spark, rows[:0]), SPEC)
    have = {(x["k"], x["t"]) for x in first.collect()}
    assert have == fold(rows[:cut])
    rest = changes_in_one_pass(feed(spark, [*rows[cut:], ("a", None, 1)]), first, SPEC).collect()
    assert have | {(x["k"], x["t"]) for x in rest if x["t"] is not None} == want
    assert sum(x["t"] is None for x in rest) == 1


def test_dense_grid_of_gaps_ties_and_no_rows(spark):
    from snapline.operators.state import dense_grid
    h = lambda n: START + timedelta(hours=n)
    hist = feed(spark, [("a", h(1), 1), ("a", h(60), 2), ("b", h(30), 3), ("c", h(500), 4), ("a", None, 9)])
    at = [h(0), h(1), h(30), h(59), h(60), h(60), h(100), None]
    grid = spark.createDataFrame([(t,) for t in at], "t timestamp_ntz")
    for width in (3600, 86400):
        got = {(r["k"], r["t"], r["changed_at"], r["v"]) for r in dense_grid(hist, grid, SPEC, bucket_seconds=width).collect()}
        assert got == {("a", h(1), h(1), 1), ("a", h(30), h(1), 1), ("a", h(59), h(1), 1), ("a", h(60), h(60), 2),
                       ("a", h(100), h(60), 2), ("b", h(30), h(30), 3), ("b", h(59), h(30), 3), ("b", h(60), h(30), 3),
                       ("b", h(100), h(30), 3)}
    assert dense_grid(hist, grid.limit(0), SPEC).collect() == [] and dense_grid(hist.limit(0), grid, SPEC).collect() == []


def test_small_blocks_share_a_python_call(spark):
    from snapline.operators.spacing import _per_block
    rows = [(f"k{i % 200}" if i % 200 else None, i // 600, i) for i in range(1200)]           # 400 blocks of three rows
    df = spark.createDataFrame(rows, "k string, _bk long, _t long").withColumn("n", F.lit(0).cast("long"))

    def mark(pdf, starts):
        assert all(len(set(zip(b["k"], b["_bk"]))) == 1 and b["_t"].is_monotonic_increasing
                   for b in (pdf.iloc[x:y] for x, y in zip(starts[:-1], starts[1:])))
        return pdf.assign(n=[len(starts) - 1, *[0] * (len(pdf) - 1)])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")                      # blocks go over batches
    try:
        got = _per_block(df, ["k"], mark).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["k"] or "", r["_bk"], r["_t"]) for r in got) == sorted((k or "", b, t) for k, b, t in rows)
    assert sum(r["n"] for r in got) == 400 and sum(r["n"] > 0 for r in got) < 60


def test_a_call_holds_a_block_that_spans_batches(spark):
    rows = [("a" if i % 3 else "b", START + timedelta(minutes=i)) for i in range(900)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        df = spark.createDataFrame(rows, "k string, t timestamp_ntz")
        got = spaced(df, ["k"], "t", F.col("t") + F.expr("INTERVAL 95 MINUTES"), block_seconds=6 * 3600).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(x["k"], x["t"]) for x in got} == walk(rows, lambda t: timedelta(minutes=95))
