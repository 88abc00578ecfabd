from datetime import datetime

from pyspark.sql import functions as F

from snapline.operators.health import controller_rows, broker_rows, incidents, status_board
from snapline.plans.derived import pages as page_view
from snapline.sources.pages import drop_empty_snapshots, snapshot_completeness


def test_completeness(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(t1, i) for i in range(237)] + [(t2, i) for i in range(200)]
    df = spark.createDataFrame(rows, "request_timestamp timestamp_ntz, stationcode int").selectExpr(
        "*", "1 AS capacity", "1 AS numbikesavailable")
    pages = page_view(spark, "", df, 100).withColumnRenamed("request_timestamp", "c")
    ok = {r["c"]: (r["n_pages"], r["n_records"], r["complete"]) for r in snapshot_completeness(pages, "c", 100).collect()}
    assert ok[t1] == (3, 237, True)
    assert ok[t2] == (3, 200, True)   # 100 + 100 + empty terminating page
    cut = pages.filter(~((F.col("c") == t2) & (F.col("page_no") == 2)))
    ok = {r["c"]: r["complete"] for r in snapshot_completeness(cut, "c", 100).collect()}
    assert ok[t2] is False            # full last page: truncated
    empty = spark.createDataFrame([(datetime(2024, 1, 3), 0, '{"results":[]}')], pages.schema)
    assert drop_empty_snapshots(pages.unionByName(empty), "c").count() == pages.count()


def test_controller_derivation(spark):
    probes = spark.createDataFrame(
        [(datetime(2024, 1, 1, 1), True, 3.0, 1, 2, -1, None),
         (datetime(2024, 1, 1, 2), True, 3.0, 1, 2, 1, None),
         (datetime(2024, 1, 1, 3), False, None, 1, 2, 1, "unreachable")],
        "check_timestamp timestamp_ntz, reachable boolean, latency_ms double, broker_count int, "
        "topic_count int, controller_id int, error string")
    k = broker_rows(probes)
    kr = controller_rows(k).orderBy("check_timestamp").collect()
    assert [r["status"] for r in kr] == ["down", "healthy", "down"]
    assert kr[0]["error_message"].startswith("cluster reports no controller")
    assert kr[2]["error_message"] == "unreachable"
    h = k.drop("controller_id").unionByName(controller_rows(k))
    board = status_board(h).collect()
    assert [r["component"] for r in board] == ["kafka", "kraft_controller"]
    inc = incidents(h, datetime(2024, 1, 1, 3), 24).collect()
    assert [r["check_timestamp"].hour for r in inc] == [3, 3, 1]
