"""Merged day bitmaps against plain distinct counts."""
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from snapline.operators.distinct import day_bitmaps, distinct_counts, number_keys
from tests.test_loads import SPEC, START, feed


def test_any_range_equals_count_distinct(spark, tmp_path):
    r = random.Random(2)
    rows = [(f"k{r.randrange(400)}", START + timedelta(seconds=r.randrange(20 * 86400)), 1) for _ in range(2000)]
    rows += [("hot", START + timedelta(minutes=m), 1) for m in range(1000)] + rows[:300]
    rows += [(None, START, 1), ("x", None, 1), ("old", datetime(1970, 1, 1), 1)]
    df = feed(spark, rows)
    number_keys(df, SPEC).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    n = len({k for k, *_ in rows if k is not None})
    assert sorted(x["id"] for x in ids.collect()) == list(range(1, n + 1))
    day_bitmaps(df, ids, SPEC).write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    for lo, hi in ((0, 20), (3, 4), (5, 12), (30, 40)):
        at = [(START + timedelta(days=x)).date() for x in (lo, hi)]
        on = (F.col("day") >= F.lit(at[0])) & (F.col("day") < F.lit(at[1]))
        got = distinct_counts(days.filter(on).withColumn("all", F.lit(1)), ["all"]).collect()
        want = [x for x in rows if x[1] and at[0] <= x[1].date() < at[1]]
        if not want:
            assert not got
            continue
        assert (got[0]["n_cycles"], got[0]["n_keys"], got[0]["n_rows"]) == (
            len({t for _, t, _ in want}), len({k for k, *_ in want if k}), len(want))
    every = distinct_counts(days.withColumn("all", F.lit(1)), ["all"]).first()      # undated rows too
    assert (every["n_keys"], every["n_rows"]) == (n, len(rows))


def test_the_dictionary_only_grows(spark, tmp_path):
    a = feed(spark, [(f"k{i}", START, 1) for i in range(50)])
    number_keys(a, SPEC).write.parquet(str(tmp_path / "ids"))
    known = spark.read.parquet(str(tmp_path / "ids"))
    more = number_keys(feed(spark, [(f"k{i}", START, 1) for i in range(40, 90)]), SPEC, known, buckets=3)
    got = {x["k"]: x["id"] for x in more.collect()}
    assert sorted(got.values()) == list(range(1, 91)) and all(got[x["k"]] == x["id"] for x in known.collect())
    assert number_keys(a.limit(0), SPEC).count() == 0
    assert distinct_counts(day_bitmaps(a.limit(0), known, SPEC), ["day"]).count() == 0
