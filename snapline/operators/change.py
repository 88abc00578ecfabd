"""Change filters: keep only rows that are new or differ in a compared field.

C1 ``changes_vs_state``  faithful: every batch row against the state before the batch.
C2 ``changes_as_of``     each row not yet stored against its predecessor by cycle in stored
                         history + batch, and against the look-back of its own cycle; replay-safe.
``changes_in_one_pass``  the same for a batch of any span.
``changes_sequential``   C2 over one self-contained input (no stored history).
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapline.operators.sequence import asof_join, with_neighbor
from snapline.operators.spacing import _cut, spaced
from snapline.spec import FeedSpec


def differs(compared: list[str] | tuple[str, ...], prev: str) -> Column:
    """The predecessor is missing, or some compared field IS DISTINCT FROM it."""
    diffs = [~F.col(c).eqNullSafe(F.col(f"{prev}.{c}")) for c in compared]
    return F.col(prev).isNull() | reduce(lambda a, b: a | b, diffs)


def _null_key(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def changes_vs_state(batch: DataFrame, state: DataFrame, spec: FeedSpec) -> DataFrame:
    """Left-join the batch to the last known state per key, keep new or changed.

    NULL keys never match, so they are always kept. The state side is one row per key;
    the join strategy is left to AQE, which broadcasts it only when its measured size
    is under the broadcast threshold.
    """
    keys = spec.keys
    st = state.select(*keys, F.struct(*[F.col(c) for c in spec.compared]).alias("_last"))
    j = batch.join(st, keys, "left")
    keep = _null_key(keys) | differs(spec.compared, "_last")
    return j.filter(keep).drop("_last")


def changes_sequential(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Keep each row that is the first of its key or differs from its predecessor.

    Exact sequential change filter (no look-back expiry) over a deduplicated input.
    """
    x = with_neighbor(df, spec.keys, spec.cycle, list(spec.compared),
                      buckets=spec.buckets, name="_prev")
    return x.filter(_null_key(spec.keys) | differs(spec.compared, "_prev")).drop("_prev")


def batch_bounds(batch: DataFrame, spec: FeedSpec) -> tuple[datetime | None, datetime | None]:
    """(min, max) cycle of a batch: one aggregate row, used as partition-pruning literals."""
    r = batch.agg(F.min(spec.cycle).alias("lo"), F.max(spec.cycle).alias("hi")).first()
    return r["lo"], r["hi"]


def history_window(history: DataFrame, spec: FeedSpec, lo: datetime, hi: datetime,
                   lookback_days: int | None) -> DataFrame:
    """Stored rows that can precede or match batch rows with cycles in [lo, hi].

    Filters on the partition date as well as on the cycle: Spark does not derive the
    partition predicate from the timestamp one.
    """
    start = None if lookback_days is None else lo - timedelta(days=lookback_days)
    cond = (F.col(spec.date_col) <= F.lit(hi.date())) & (F.col(spec.cycle) <= F.lit(hi))
    if start is not None:
        cond = cond & (F.col(spec.date_col) >= F.lit(start.date())) & (F.col(spec.cycle) >= F.lit(start))
    return history.filter(cond)


def changes_as_of(batch: DataFrame, history: DataFrame, spec: FeedSpec,
                  lookback_days: int | None = -1,
                  bounds: tuple | None = None) -> DataFrame:
    """Rows of ``batch`` (deduplicated) to insert into ``history``.

    A row is kept when its key has no kept row at most ``lookback_days`` older than it
    (per row, inclusive), or when a compared field differs from its predecessor by cycle.
    A row already stored (same key and cycle) is skipped, so replaying a batch inserts
    nothing, and consecutive batches give the same rows however the feed is cut. Rows
    without a cycle have nothing to be compared with and are kept.

    A batch spans at most the look-back (``load_batch`` cuts longer ones): then only a
    key's run of values that began before the batch can outlive the look-back inside it,
    and at most once. Of the stored rows older than the batch only the newest per key
    matters, so the look-back part is reduced to one narrow row per key by an aggregate
    (combined map-side) before it meets the batch.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    lo, hi = bounds or batch_bounds(batch, spec)
    if lo is None:
        return batch
    if lookback_days is not None and hi - lo > timedelta(days=lookback_days):
        raise ValueError(f"a batch may span at most the look-back of {lookback_days} days")
    from snapline.operators.state import latest_per_key
    keys, cycle, cols = spec.keys, F.col(spec.cycle), batch.columns
    narrow = [*keys, spec.cycle, *spec.compared]
    window = history_window(history, spec, lo, hi, lookback_days)
    within = (window.filter((F.col(spec.date_col) >= F.lit(lo.date())) & (cycle >= F.lit(lo)))
              .select(*narrow).withColumn("_fresh", F.lit(False)))
    before = latest_per_key(window.filter(cycle < F.lit(lo)).select(*narrow), keys, spec.cycle,
                            narrow).select(*narrow)
    fresh = (batch.filter(cycle.isNotNull())
             .join(within.select(*keys, spec.cycle), keys + [spec.cycle], "left_anti")
             .withColumn("_fresh", F.lit(True)))
    inside = fresh.unionByName(within, allowMissingColumns=True)
    u = inside.unionByName(before.withColumn("_fresh", F.lit(False)), allowMissingColumns=True)
    x = with_neighbor(u, keys, spec.cycle, list(spec.compared), buckets=spec.buckets, name="_prev")
    out = (x.filter(F.col("_fresh") & (_null_key(keys) | differs(spec.compared, "_prev")))
           .select(*cols).unionByName(batch.filter(cycle.isNull())))
    if lookback_days is None:
        return out
    return out.unionByName(_outlived(inside, before, spec, hi, lookback_days, cols))


def changes_in_one_pass(batch: DataFrame, history: DataFrame, spec: FeedSpec, lookback_days: int | None = -1,
                        bounds: tuple | None = None) -> DataFrame:
    """C2/C5 for a batch of any span: the rows that :func:`changes_as_of` gives for consecutive
    batches, in a number of jobs that does not grow with the look-backs the batch spans.

    Stored rows, rows without a predecessor and rows that differ from it start a run. Inside a
    run nothing changes, so only rows past the look-back of the run's start can be kept; they are
    few in a feed that changes, and :func:`spaced` chooses among them.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    lo, hi = bounds or batch_bounds(batch, spec)
    if lo is None:
        return batch
    from snapline.operators.state import latest_per_key
    keys, cycle = spec.keys, F.col(spec.cycle)
    narrow = [*keys, spec.cycle, *spec.compared]
    window = history_window(history, spec, lo, hi, lookback_days)
    within = window.filter((F.col(spec.date_col) >= F.lit(lo.date())) & (cycle >= F.lit(lo))).select(*narrow)
    before = latest_per_key(window.filter(cycle < F.lit(lo)).select(*narrow), keys, spec.cycle, narrow).select(*narrow)
    fresh = batch.filter(cycle.isNotNull()).join(within.select(*keys, spec.cycle), keys + [spec.cycle], "left_anti")
    return derive(fresh, within.unionByName(before), spec, lookback_days).unionByName(batch.filter(cycle.isNull()))


def derive(fresh: DataFrame, given: DataFrame, spec: FeedSpec, lookback_days: int | None) -> DataFrame:
    """Rows of ``fresh`` to keep, beside ``given`` rows (key, cycle, compared columns) that are
    kept already; both have cycles, and no (key, cycle) twice."""
    keys, cycle = spec.keys, F.col(spec.cycle)
    narrow = [*keys, spec.cycle, *spec.compared]
    u = (fresh.select(*narrow).withColumn("_fresh", F.lit(True))
         .unionByName(given.select(*narrow).withColumn("_fresh", F.lit(False))))
    x = with_neighbor(u, keys, spec.cycle, list(spec.compared), buckets=spec.buckets, name="_prev").select(
        *keys, spec.cycle, "_fresh",
        (~F.col("_fresh") | _null_key(keys) | differs(spec.compared, "_prev")).alias("_start"))
    if lookback_days is None:
        chosen = x.filter("_fresh and _start").select(*keys, spec.cycle)
    else:
        reach = F.expr(f"INTERVAL {int(lookback_days)} DAYS")
        x = _cut(x, "change-runs")
        runs = asof_join(x.filter(~F.col("_start")), x.filter("_start").select(*keys, F.col(spec.cycle).alias("_run")),
                         keys, spec.cycle, "_run", [], buckets=spec.buckets, name="_began")
        late = _cut(runs.withColumn("_run", F.col("_began._run")).filter(cycle > F.col("_run") + reach)
                    .select(*keys, "_run", spec.cycle), "change-outlived")
        chosen = x.filter("_fresh and _start").select(*keys, spec.cycle)
        if not late.isEmpty():
            again = spaced(late, [*keys, "_run"], spec.cycle, cycle + reach + F.expr("INTERVAL 1 MICROSECOND"),
                           block_seconds=max(4 * 86400 * max(1, lookback_days), max(spec.buckets)))
            chosen = chosen.unionByName(again.select(*keys, spec.cycle))
    chosen = chosen.withColumnsRenamed({c: f"_c_{c}" for c in [*keys, spec.cycle]})
    return fresh.join(chosen, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in [*keys, spec.cycle]], "left_semi")


def _outlived(inside: DataFrame, before: DataFrame, spec: FeedSpec, hi: datetime, days: int,
              cols: list[str]) -> DataFrame:
    """Unchanged rows to keep because their key's last kept row has left the look-back: per
    key, the first fresh row past it, unless the key changed or has a stored row earlier in
    the batch's range (the look-back then starts again there)."""
    reach = F.expr(f"INTERVAL {int(days)} DAYS")
    old = (before.filter(F.col(spec.cycle) + reach < F.lit(hi))
           .select(*spec.keys, F.col(spec.cycle).alias("_kept"),
                   F.struct(*spec.compared).alias("_last")))
    rest = [c for c in cols if c not in (*spec.keys, spec.cycle)]
    restart = F.when(~F.col("_fresh") | differs(spec.compared, "_last"), F.col(spec.cycle))
    past = F.when(F.col("_fresh") & (F.col(spec.cycle) > F.col("_kept") + reach),
                  F.struct(spec.cycle, *rest))
    g = inside.join(old, spec.keys).groupBy(*spec.keys).agg(
        F.min(restart).alias("_restart"), F.min(past).alias("_row"))
    due = F.col("_restart").isNull() | (F.col(f"_row.{spec.cycle}") < F.col("_restart"))
    return (g.filter(F.col("_row").isNotNull() & due)
            .select(*[F.col(c) if c in spec.keys else F.col(f"_row.{c}").alias(c) for c in cols]))
