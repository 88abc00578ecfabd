"""Cadence operators over a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapline.functions.cadence import Cadence, effective_interval, is_night
from snapline.operators.spacing import spaced


def thin(df: DataFrame, keys: list[str], ts: str, cadence: Cadence) -> DataFrame:
    """At most one row per key per effective interval — the first row of each
    ``(key, night flag, floor(epoch / interval))`` bucket, as an aggregation
    (map-side partial, so a hot key is reduced before the shuffle)."""
    keys = list(keys)
    interval = effective_interval(ts, cadence)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    x = df.select("*", is_night(ts, cadence).alias("night"),
                  F.floor(micros / (interval.cast("bigint") * F.lit(1_000_000))).alias("slot"))
    rest = [c for c in df.columns if c not in keys and c != ts]
    first = F.min(F.struct(F.col(ts), *[F.col(c) for c in rest])).alias("_f")
    return (x.groupBy(*keys, "night", "slot").agg(first)
             .select(*keys, "night", "slot", F.col("_f." + ts).alias(ts),
                     *[F.col("_f." + c).alias(c) for c in rest]))


def thin_by_gap(df: DataFrame, keys: list[str], ts: str, cadence: Cadence, *, block_gaps: int = 64) -> DataFrame:
    """N3 as the poll loop does it: per key the first row, then always the first one at least the
    interval in force at the row *kept before* it later (night intervals included), with ``night``
    and ``interval_seconds`` of the kept row.

    A hot key is cut into blocks of ``block_gaps`` base intervals (see :mod:`spacing`). Of rows
    that share (key, ``ts``) the smallest by the other columns stays; rows without a ``ts`` are
    never kept.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != ts]
    gap = effective_interval(ts, cadence)
    until = F.timestamp_micros(F.unix_micros(F.col(ts).cast("timestamp")) + gap.cast("bigint") * F.lit(1_000_000))
    kept = spaced(df, keys, ts, until, block_seconds=block_gaps * int(cadence.base_seconds))
    kept = kept.withColumnsRenamed({k: f"{k}__k" for k in [*keys, ts]})
    x = df.join(kept, [*[F.col(k).eqNullSafe(F.col(f"{k}__k")) for k in keys], F.col(ts) == F.col(f"{ts}__k")], "left_semi")
    first = F.min(F.struct(*[F.col(c) for c in rest])).alias("_f") if rest else F.count(F.lit(1)).alias("_f")
    return (x.groupBy(*keys, ts).agg(first)
             .select(*keys, ts, is_night(ts, cadence).alias("night"), gap.alias("interval_seconds"),
                     *[F.col("_f." + c).alias(c) for c in rest]))


def expected_cycles(days: DataFrame, day_col: str, cadence: Cadence) -> DataFrame:
    """Polls expected per day given the cadence: every minute of the day counts
    ``base / effective interval`` polls of one base interval (1 by day, 1/4 at night).

    ``days`` holds distinct dates; each expands to its 1 440 minutes (work grows with
    the days covered, not with rows)."""
    start = F.col(day_col).cast("timestamp_ntz")
    minutes = F.sequence(start, start + F.expr("INTERVAL 1439 MINUTES"), F.expr("INTERVAL 1 MINUTE"))
    m = days.select(F.col(day_col), F.explode(minutes).alias("minute"))
    night = is_night("minute", cadence)
    per_base = F.when(night, F.lit(1.0 / cadence.multiplier)).otherwise(F.lit(1.0))
    return m.groupBy(day_col).agg(
        F.count(F.lit(1)).alias("n_minutes"),
        F.sum(night.cast("int")).cast("bigint").alias("night_minutes"),
        (F.sum(per_base) * F.lit(60.0 / cadence.base_seconds)).alias("expected_cycles"),
    )
