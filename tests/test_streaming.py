import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as E
from snapline.plans.catalog import deduped
from snapline.plans.streams import land_raw_days, raw_stream
from snapline.sources.logs import checkpoint_offsets, latest_batch
from snapline.spec import STATION_SPEC
from snapline.streaming.jobs import run_available
from snapline.operators.envelope import apply_types
from snapline.streaming.stateful import stateful_changes
from tests.conftest import SF_SMALL


def test_resume_and_replay_equal_single_run(spark):
    s = E.queries()["stream_resume"](spark, SF_SMALL)
    b = E.queries()["change_filter_asof"](spark, SF_SMALL)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0


def brute_fold(pdf, days):
    """Per-row sequential fold with look-back expiry, plain Python."""
    out, last = [], {}
    for r in pdf.sort_values(["stationcode", "request_timestamp"]).itertuples(index=False):
        vals = tuple(None if pd.isna(getattr(r, c)) else getattr(r, c) for c in STATION_SPEC.compared)
        prev = last.get(r.stationcode)
        if prev is None or prev[1] < r.request_timestamp - pd.Timedelta(days=days) or prev[0] != vals:
            out.append((r.stationcode, r.request_timestamp))
            last[r.stationcode] = (vals, r.request_timestamp)
    return set(out)


import pytest


@pytest.mark.parametrize("watermark", [None, "1 day"])
def test_stateful_lookback_matches_brute_force(spark, tmp_path, watermark):
    root = str(tmp_path)
    land_raw_days(spark, SF_SMALL, f"{root}/raw")
    typed = apply_types(raw_stream(spark, f"{root}/raw"))
    kept = stateful_changes(typed, STATION_SPEC, lookback_days=1, watermark_delay=watermark)
    run_available(kept, "parquet", f"{root}/ck", path=f"{root}/out")
    got = {(r[0], pd.Timestamp(r[1])) for r in
           spark.read.parquet(f"{root}/out").select("stationcode", "request_timestamp").collect()}
    want = brute_fold(deduped(spark, SF_SMALL).toPandas(), 1)
    assert got == want
    offs = checkpoint_offsets(spark, f"{root}/ck")
    assert latest_batch(offs).first()["batch_id"] == offs.count() - 1


@pytest.mark.parametrize("watermark", [None, "1 day"])
def test_keys_share_state_rows_and_give_the_same(spark, tmp_path, watermark):
    root = str(tmp_path)
    land_raw_days(spark, SF_SMALL, f"{root}/raw")
    typed = apply_types(raw_stream(spark, f"{root}/raw"))
    kept = stateful_changes(typed, STATION_SPEC, lookback_days=1, watermark_delay=watermark, groups=3)
    run_available(kept, "parquet", f"{root}/ck", path=f"{root}/out")
    got = {(r[0], pd.Timestamp(r[1])) for r in
           spark.read.parquet(f"{root}/out").select("stationcode", "request_timestamp").collect()}
    assert got == brute_fold(deduped(spark, SF_SMALL).toPandas(), 1)
    assert 1 <= spark.read.format("statestore").load(f"{root}/ck").count() <= 3


def test_fold_of_copies_late_and_undated_rows():
    from snapline.streaming.stateful import fold_keys
    at = lambda day: pd.Timestamp("2024-01-01") + pd.Timedelta(days=day)
    row = lambda key, day, v, seen=0: {"_key": key, "_vals": v, "request_timestamp": None if day is None else at(day),
                                       "kafka_timestamp": at(seen)}
    known = {}
    fold = lambda *rows: list(fold_keys(
        pd.DataFrame(rows).astype({"request_timestamp": "datetime64[us]"}), STATION_SPEC, 7, known)
        [["_key", "request_timestamp", "_vals"]].itertuples(index=False, name=None))
    assert fold(row("b", 1, "x"), row("a", 2, "x", 3), row("a", 2, "y", 2), row("a", 1, "x"), row("a", 3, "y")) == [
        ("a", at(1), "x"), ("a", at(2), "y"), ("b", at(1), "x")]
    # a late row meets the state before the batch, a copy of the newest cycle is dropped, the look-back is per row
    assert fold(row("a", 0, "y"), row("a", 2.5, "z"), row("a", 3, "q"), row("a", 9, "y"), row("a", 9.5, "y")) == [
        ("a", at(2.5), "z"), ("a", at(9.5), "y")]
    assert known["a"][0] == "y" and [pd.Timestamp(t, unit="us") for t in known["a"][1:]] == [at(9.5), at(9.5)]
    got = fold(row("c", None, "x"), row("c", None, "y"), row("c", 1, "x"))
    assert [(k, pd.isna(t)) for k, t, _ in got] == [("c", True), ("c", False)] and len(known) == 3
    assert [pd.isna(t) for _, t, _ in fold(row("d", None, "x"))] == [True] and "d" not in known
