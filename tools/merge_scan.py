"""Bytes scanned by one merge into a history of 30 day-partitions (BASELINE metric).

Usage: python tools/merge_scan.py [sf_dir]

Loads all but the last day of the derived feed into a history (29 day-partitions),
then runs the last day's as-of change filter against it and reads the file-scan
metrics of the executed plan: how many history partitions, files and bytes the
merge touched, against the whole history. With a 7-day look-back it should touch
the batch's day and the 7 days before it only. Prints one JSON line.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def folder_bytes(path: str) -> int:
    return sum(os.path.getsize(p) for p in glob.glob(os.path.join(path, "**", "*"), recursive=True)
               if os.path.isfile(p) and not os.path.basename(p).startswith((".", "_")))


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def file_scans(plan) -> list:
    """All file-scan nodes of an executed (adaptive) plan."""
    out, todo = [], [plan]
    while todo:
        node = todo.pop()
        cls = node.getClass().getSimpleName()
        if cls == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if cls.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if cls == "ReusedExchangeExec":
            todo.append(node.child())
            continue
        if cls == "FileSourceScanExec":
            out.append(node)
        todo.extend(_seq(node.children()))
    return out


def metric(node, name):
    m = node.metrics()
    return int(m.apply(name).value()) if m.contains(name) else None


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    root = tempfile.mkdtemp(prefix="merge-scan-", dir="/tmp")
    from snapline.session import get_session
    spark = get_session("local[8]", 8, app_name="merge-scan")
    spark.sparkContext.setLogLevel("ERROR")
    from snapline.operators.change import changes_as_of
    from snapline.operators.dedup import dedup_earliest
    from snapline.operators.envelope import apply_types
    from snapline.plans.streams import _silver, land_raw_days
    from snapline.sources.raw import read_raw
    from snapline.spec import STATION_SPEC as S
    from snapline.streaming.silver import load_files_in_order
    dirs = land_raw_days(spark, sf, os.path.join(root, "raw"))
    silver = os.path.join(root, "silver")
    load_files_in_order(spark, dirs[:-1], silver, "r", lookback_days=7)
    batch = dedup_earliest(apply_types(read_raw(spark, dirs[-1])), S.keys + [S.cycle], S.order)
    hist = _silver(spark, silver).drop("silver_updated_at", "batch_id")
    rows = changes_as_of(batch, hist, S, 7)
    n_rows = len(rows.collect())  # an action on this plan itself, so its scan metrics are filled
    scans = [n for n in file_scans(rows._jdf.queryExecution().executedPlan()) if "silver" in n.toString()]
    seen = {}
    for n in scans:  # a scan reached twice (reused exchange) counts once
        if (metric(n, "numFiles") or 0) > 0 or n.toString() not in seen:
            seen[n.toString()] = n
    parts = sum(metric(n, "numPartitions") or 0 for n in seen.values())
    files = sum(metric(n, "numFiles") or 0 for n in seen.values())
    size = sum(metric(n, "filesSize") or 0 for n in seen.values())
    print(json.dumps({"rows_inserted": n_rows, "history_day_partitions": len(glob.glob(os.path.join(silver, "request_date=*"))),
                      "history_bytes": folder_bytes(silver), "scans": len(seen),
                      "partitions_read": parts, "files_read": files, "bytes_read": size,
                      "history_share_read": round(size / folder_bytes(silver), 3)}))


if __name__ == "__main__":
    main()
