"""Silver load that repairs the history when rows arrive late.

An insert-only load compares a late row with what is stored, but cannot bring back a row that was
dropped as unchanged before the late one came between, nor take back a stored row that the late
one makes a repetition. Here every batch is landed first, and what it touches is derived again
from the landed rows. The history then equals that of the whole feed in cycle order, whatever
order rows arrive in.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from snapline.operators.change import derive, differs
from snapline.operators.dedup import dedup_earliest
from snapline.operators.envelope import apply_types
from snapline.operators.merge import (
    BATCH_COL, finish_swaps, history_schema, read_history, replace_dates, write_history)
from snapline.operators.sequence import with_neighbor
from snapline.operators.spacing import _cut
from snapline.operators.state import latest_per_key
from snapline.spec import FeedSpec, STATION_SPEC
from snapline.streaming.silver import STAMP, stored_schema
from snapline.streaming.sinks import utc_now


def _has_key(spec: FeedSpec) -> Column:
    ok = F.col(spec.cycle).isNotNull()
    for k in spec.keys:
        ok = ok & F.col(k).isNotNull()
    return ok


def load_with_repair(raw: DataFrame, path: str, landed: str, batch_id: str, spec: FeedSpec = STATION_SPEC, *,
                     lookback_days: int | None = -1, typed: bool = False,
                     clock: Callable[[], datetime] = utc_now) -> tuple[int, int]:
    """Load one batch; returns (rows inserted, stored rows taken back).

    1. The batch's typed rows are written to ``landed``, a table laid out like the history.
    2. A key of the batch is touched from its first cycle in the batch on, up to the first stored
       change after its last one whose stored predecessor also lies after it: that row differs
       from a row the batch cannot reach, so it and all rows after it stay as they are. Without
       one, up to now. On-time rows touch nothing but themselves.
    3. The touched rows are read from ``landed`` (date-pruned), their earliest copies taken, and
       filtered again from the key's newest stored row before them.
    4. New rows are appended under ``batch_id``. Dates that lose rows are rewritten whole and
       swapped (:func:`replace_dates`); with none, as in a feed without late rows, the load is a
       plain append.

    Loading a batch again changes nothing. Loads of one history run one after another. Rows
    without a key or cycle are compared with nothing and appended.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    spark = raw.sparkSession
    finish_swaps(spark, path, spec)
    rows = raw if typed else apply_types(raw, date_col=spec.date_col)
    schema, landed_schema = stored_schema(rows, spec), history_schema(rows.schema, spec)
    write_history(rows, landed, spec, batch_id, stamp_col=None)
    mine = read_history(spark, landed, landed_schema, spec).filter(F.col(BATCH_COL) == batch_id).drop(BATCH_COL)
    whole, loose = mine.filter(_has_key(spec)), mine.filter(~_has_key(spec))
    loose = dedup_earliest(loose, spec.keys + [spec.cycle], spec.order)
    keys, cycle = spec.keys, F.col(spec.cycle)
    touched = _cut(whole.groupBy(*keys).agg(F.min(cycle).alias("_lo"), F.max(cycle).alias("_hi")), "repair-touched")
    lo = touched.agg(F.min("_lo").alias("lo")).first()["lo"]
    if lo is None:
        return write_history(loose, path, spec, batch_id, as_of=clock()), 0
    back = None if lookback_days is None else (lo - timedelta(days=lookback_days)).date()
    known = read_history(spark, path, schema, spec, since=back) if back else read_history(spark, path, schema, spec)
    narrow = [*keys, spec.cycle, *spec.compared]
    # A copy that came earlier at the broker replaces the stored one, so the copy order counts too.
    exact = list(dict.fromkeys([*narrow, *spec.order]))
    near = _cut(known.filter(cycle.isNotNull()).select(*exact, spec.date_col).join(touched, keys), "repair-known")

    after = with_neighbor(near.filter(cycle > F.col("_hi")), keys, spec.cycle, list(spec.compared),
                          buckets=spec.buckets, name="_prev")
    safe = (after.filter(F.col("_prev").isNotNull() & differs(spec.compared, "_prev"))
            .groupBy(*keys).agg(F.min(cycle).alias("_end")))
    ranges = _cut(touched.join(safe, keys, "left"), "repair-ranges")
    last = ranges.agg(F.max("_end").alias("m"), F.count_if(F.col("_end").isNull()).alias("open")).first()
    until = None if last["open"] else last["m"].date()
    inside = (cycle >= F.col("_lo")) & (F.col("_end").isNull() | (cycle < F.col("_end")))

    again = read_history(spark, landed, landed_schema, spec, since=lo.date(), until=until).drop(BATCH_COL)
    again = dedup_earliest(again.join(ranges, keys).filter(inside).drop("_lo", "_hi", "_end"),
                           keys + [spec.cycle], spec.order)
    base = near.filter(cycle < F.col("_lo"))
    if lookback_days is not None:
        base = base.filter(cycle >= F.col("_lo") - F.expr(f"INTERVAL {int(lookback_days)} DAYS"))
    base = latest_per_key(base.select(*narrow), keys, spec.cycle, narrow).select(*narrow)
    want = _cut(derive(again, base, spec, lookback_days), "repair-want")

    held = near.join(ranges.select(*keys, "_end"), keys).filter(inside).select(*exact, spec.date_col)
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in exact]
    wanted = want.select(*[F.col(c).alias(f"_w_{c}") for c in exact])
    gone = _cut(held.join(wanted, same, "left_anti").select(*keys, spec.cycle, spec.date_col), "repair-gone")
    there = held.select(*[F.col(c).alias(f"_w_{c}") for c in exact])
    new = want.join(there, same, "left_anti").unionByName(loose.select(*want.columns))
    dates = sorted(r[0] for r in gone.select(spec.date_col).distinct().collect())      # one row a date
    if not dates:
        return write_history(new, path, spec, batch_id, as_of=clock()), 0
    new, stamp = _cut(new, "repair-new"), F.lit(clock()).cast("timestamp_ntz")
    counts = new.count(), gone.count()
    on = F.coalesce(F.col(spec.date_col).isin(dates), F.lit(False))
    stay = (read_history(spark, path, schema, spec, since=dates[0], until=dates[-1]).filter(on).drop(BATCH_COL)
            .join(gone.select(*keys, spec.cycle), keys + [spec.cycle], "left_anti"))
    # The append goes first: if the job dies after it, loading the batch again does the rest.
    write_history(new.filter(~on), path, spec, batch_id, as_of=clock())
    replace_dates(stay.unionByName(new.filter(on).withColumn(STAMP, stamp), allowMissingColumns=True), path, spec, dates, batch_id)
    return counts


def repair_sink(path: str, landed: str, run_id: str, spec: FeedSpec = STATION_SPEC, *, lookback_days: int | None = -1,
                typed: bool = False, clock: Callable[[], datetime] = utc_now,
                metrics: list | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callable of :func:`load_with_repair`, batch id ``<run_id>-<epoch>``."""

    def run(df: DataFrame, epoch_id: int) -> None:
        got = load_with_repair(df, path, landed, f"{run_id}-{epoch_id:06d}", spec, lookback_days=lookback_days,
                               typed=typed, clock=clock)
        if metrics is not None:
            metrics.append((epoch_id, *got))

    return run
