"""State derived on demand from the change history."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from snapline.operators.sequence import asof_join, bucket_of, with_neighbor
from snapline.spec import FeedSpec


def latest_per_key(df: DataFrame, keys: list[str], order: str, cols: list[str] | None = None) -> DataFrame:
    """Top-1 per key by ``order`` (descending) as one aggregation, no sort of the key.

    ``max`` of a struct led by ``order``: ties fall to the following columns, so the
    result is deterministic. Rows with a NULL ``order`` are never "latest".
    """
    keys = list(keys)
    cols = [c for c in (cols or df.columns) if c not in keys and c != order]
    best = F.max(F.struct(F.col(order), *[F.col(c) for c in cols])).alias("_b")
    return (df.filter(F.col(order).isNotNull())
              .groupBy(*keys).agg(best)
              .select(*keys, F.col("_b." + order).alias(order), *[F.col("_b." + c).alias(c) for c in cols]))


def last_known(history: DataFrame, spec: FeedSpec, as_of: datetime,
               lookback_days: int | None = -1, before: datetime | None = None,
               cols: list[str] | None = None) -> DataFrame:
    """Last stored row per key with ``cycle >= as_of - N days`` (inclusive).

    A key unchanged for longer than the look-back counts as never seen. ``before``
    (exclusive) bounds the state to rows older than a batch. Both bounds are also put
    on the partition date so the scan prunes partitions.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    h = history
    if lookback_days is not None:
        start = as_of - timedelta(days=lookback_days)
        if spec.date_col in h.columns:
            h = h.filter(F.col(spec.date_col) >= F.lit(start.date()))
        h = h.filter(F.col(spec.cycle) >= F.lit(start))
    if before is not None:
        if spec.date_col in h.columns:
            h = h.filter(F.col(spec.date_col) <= F.lit(before.date()))
        h = h.filter(F.col(spec.cycle) < F.lit(before))
    return latest_per_key(h, spec.keys, spec.cycle, cols)


def current_state(history: DataFrame, spec: FeedSpec, cols: list[str] | None = None) -> DataFrame:
    """Newest row per key over the whole history."""
    return latest_per_key(history, spec.keys, spec.cycle, cols)


def state_as_of(history: DataFrame, spec: FeedSpec, t: datetime, cols: list[str] | None = None) -> DataFrame:
    """State of every key at time ``t`` (newest change at or before ``t``)."""
    h = history
    if spec.date_col in h.columns:
        h = h.filter(F.col(spec.date_col) <= F.lit(t.date()))
    return latest_per_key(h.filter(F.col(spec.cycle) <= F.lit(t)), spec.keys, spec.cycle, cols)


def intervals(history: DataFrame, spec: FeedSpec, cols: list[str] | None = None) -> DataFrame:
    """Validity interval ``[valid_from, valid_to)`` of each change row;
    ``valid_to`` is the next change of the same key, NULL for the current one."""
    cols = list(cols or spec.compared)
    x = with_neighbor(history.select(*spec.keys, spec.cycle, *cols), spec.keys, spec.cycle,
                      [spec.cycle], direction="next", buckets=spec.buckets, name="_next")
    return x.select(*spec.keys, F.col(spec.cycle).alias("valid_from"),
                    F.col("_next." + spec.cycle).alias("valid_to"), *cols)


def dimension(df: DataFrame, spec: FeedSpec, static: list[str] | None = None) -> DataFrame:
    """Latest quasi-static attributes per key, with first and last sighting."""
    static = list(static or spec.static)
    best = F.max(F.struct(F.col(spec.cycle), *[F.col(c) for c in static])).alias("_b")
    return (df.filter(F.col(spec.cycle).isNotNull())
              .groupBy(*spec.keys)
              .agg(best, F.min(spec.cycle).alias("first_seen"))
              .select(*spec.keys, *[F.col("_b." + c).alias(c) for c in static],
                      "first_seen", F.col("_b." + spec.cycle).alias("last_seen")))


def reconstruct(history: DataFrame, grid: DataFrame, spec: FeedSpec, cols: list[str] | None = None) -> DataFrame:
    """The state of each ``(key, cycle)`` of ``grid`` rebuilt from the change rows
    (newest change at or before the cycle): what makes change-only storage lossless."""
    cols = list(cols or spec.compared)
    g = grid.select(*spec.keys, spec.cycle)
    j = asof_join(g, history.select(*spec.keys, spec.cycle, *cols), spec.keys, spec.cycle, spec.cycle,
                  cols, buckets=spec.buckets, name="_s")
    return j.select(*spec.keys, spec.cycle, F.col("_s." + spec.cycle).alias("changed_at"),
                    *[F.col("_s." + c).alias(c) for c in cols])


def dense_grid(history: DataFrame, cycles: DataFrame, spec: FeedSpec, cols: list[str] | None = None, *,
               bucket_seconds: int = 86400) -> DataFrame:
    """The state of every key at every cycle of ``cycles`` (one column, the spec's cycle) from
    its first change on, with ``changed_at``, the change in force.

    A range join of validity intervals with cycles: intervals are cut at the edges of time
    buckets, so both sides meet on the bucket's number, and the cycle must lie in the interval. A
    key's rows are spread over its buckets; a row is read once per bucket its interval spans, a
    current one up to the last cycle. Cycles may repeat; each counts once. Rows or cycles without a
    time are left out.
    """
    cols = list(cols or spec.compared)
    grid = (cycles.select(F.col(spec.cycle)).filter(F.col(spec.cycle).isNotNull()).distinct()
            .withColumn("_bk", bucket_of(spec.cycle, bucket_seconds)))
    ends = grid.agg(F.min("_bk").alias("lo"), F.max("_bk").alias("hi")).first()
    if ends["hi"] is None:
        ends = {"lo": 0, "hi": -1}
    iv = intervals(history.filter(F.col(spec.cycle).isNotNull()), spec, cols)
    first = F.greatest(bucket_of("valid_from", bucket_seconds), F.lit(ends["lo"]))
    last = F.least(F.coalesce(bucket_of("valid_to", bucket_seconds), F.lit(ends["hi"])), F.lit(ends["hi"]))
    cut = (iv.withColumns({"_b0": first, "_b1": last}).filter(F.col("_b0") <= F.col("_b1"))
           .withColumn("_bk", F.explode(F.sequence("_b0", "_b1"))))
    at = F.col(spec.cycle)
    return (cut.join(grid, "_bk").filter((at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))
            .select(*spec.keys, at, F.col("valid_from").alias("changed_at"), *cols))
