import random
from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from snapline.operators.sequence import with_neighbor


def test_matches_plain_lag_and_lead_with_hot_key(spark):
    rnd = random.Random(7)
    base = datetime(2024, 1, 1)
    data, seen = [], set()
    for _ in range(3000):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}"
        t = base + timedelta(minutes=rnd.randint(0, 60 * 24 * 20))
        if (k, t) in seen:
            continue
        seen.add((k, t))
        data.append((k, t, rnd.randint(0, 3)))
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, v int")
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("k", "t", F.lag("v").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    for buckets in ((3600,), (86400,), (7 * 86400,), (600, 3600, 86400), (3600, 86400, 30 * 86400)):
        p = with_neighbor(df, ["k"], "t", ["v"], direction="prev", buckets=buckets, name="x") \
            .select("k", "t", F.col("x.v").alias("p"))
        n = with_neighbor(df, ["k"], "t", ["v"], direction="next", buckets=buckets, name="x") \
            .select("k", "t", F.col("x.v").alias("n"))
        got = p.join(n, ["k", "t"])
        assert got.count() == df.count()
        assert got.exceptAll(ref.select("k", "t", "p", "n")).count() == 0


def test_rows_without_order_have_no_neighbour(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", datetime(2024, 1, 1), 2), ("a", datetime(2024, 1, 3), 3),
                                ("b", None, 4)], "k string, t timestamp_ntz, v int")
    got = {r["v"]: (r["x"]["v"] if r["x"] else None)
           for r in with_neighbor(df, ["k"], "t", ["v"], buckets=(3600, 86400), name="x").collect()}
    assert got == {1: None, 2: None, 3: 2, 4: None}


def test_asof_join_matches_brute_force(spark):
    from snapline.operators.sequence import asof_join
    rnd = random.Random(5)
    base = datetime(2024, 1, 1)
    right = sorted({("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 15)}",
                     base + timedelta(minutes=rnd.randint(0, 60 * 24 * 10))) for _ in range(1500)})
    right = [(k, t, rnd.randint(0, 5)) for k, t in right]
    left = [(k, t + timedelta(minutes=rnd.choice([0, 1, 90, 60 * 30]))) for k, t, _ in right[::3]]
    left += [("hot", base - timedelta(days=1)), ("nobody", base)]
    r = spark.createDataFrame(right, "k string, t timestamp_ntz, v int")
    l = spark.createDataFrame(left, "k string, lt timestamp_ntz")
    for buckets in ((3600,), (86400,)):
        got = {(row["k"], row["lt"]): (row["_asof"]["v"] if row["_asof"] else None)
               for row in asof_join(l, r, ["k"], "lt", "t", ["v"], buckets=buckets).collect()}
        want = {}
        for k, lt in left:
            cands = [(t, v) for kk, t, v in right if kk == k and t <= lt]
            want[(k, lt)] = max(cands)[1] if cands else None
        assert got == want


def test_asof_combines_after_the_rows_are_dealt_out(spark):
    """Few compressed bytes can be very many narrow rows; no task may sort them before the shuffle."""
    from datetime import datetime, timedelta
    from pyspark.sql import functions as F
    from snapline.operators.sequence import asof_join
    t0 = datetime(2024, 1, 1)
    left = spark.createDataFrame([(k, t0 + timedelta(hours=h)) for k in ("a", "b", None) for h in (0, 5, 30, 80)], "k string, t timestamp_ntz")
    right = spark.createDataFrame([("a", t0 + timedelta(hours=4), 1), ("a", t0 + timedelta(hours=30), 2), (None, t0, 3)],
                                  "k string, s timestamp_ntz, v int")
    j = asof_join(left, right, ["k"], "t", "s", ["v"])
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    assert all("Aggregate" not in x for x in plan.split("REPARTITION_BY_COL")[-1].splitlines())
    got = {(r["k"], (r["t"] - t0) // timedelta(hours=1)): r["v"] for r in j.select("k", "t", F.col("_asof.v").alias("v")).collect()}
    assert got == {("a", 0): None, ("a", 5): 1, ("a", 30): 2, ("a", 80): 2, ("b", 0): None, ("b", 5): None, ("b", 30): None,
                   ("b", 80): None, (None, 0): 3, (None, 5): 3, (None, 30): 3, (None, 80): 3}
