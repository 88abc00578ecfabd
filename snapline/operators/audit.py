"""Verification queries over the history (A1, A2, A5, O1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapline.spec import FeedSpec


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """A1: keys held by more than one row (must be empty on the history)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def write_avoidance(deduped: DataFrame, history: DataFrame, spec: FeedSpec) -> DataFrame:
    """A2: share of writes avoided by storing changes only, two ways.

    ``grid_ratio``  = 1 - history / (cycles x keys) — right only for a dense feed;
    ``dense_ratio`` = 1 - history / deduplicated rows — the rows a filter-less load
    would really have written.
    """
    def part(df: DataFrame, **cols) -> DataFrame:
        zero = F.lit(0).cast("long")
        return df.select(*[F.coalesce(cols.get(c, zero).cast("long"), zero).alias(c)
                           for c in ("n_snapshot_rows", "n_cycles", "n_keys", "n_history_rows")])

    # Per-cycle counts, the distinct keys and the history's count, added up by one aggregate.
    cycles = deduped.groupBy(spec.cycle).agg(F.count(F.lit(1)).alias("n"))
    parts = part(cycles, n_snapshot_rows=F.col("n"), n_cycles=F.col(spec.cycle).isNotNull().cast("int"))
    keys = deduped.select(spec.keys[0]).filter(F.col(spec.keys[0]).isNotNull()).distinct()
    parts = parts.unionByName(part(keys, n_keys=F.lit(1)))
    stored = history.agg(F.count(F.lit(1)).alias("n"))
    parts = parts.unionByName(part(stored, n_history_rows=F.col("n")))
    j = parts.agg(*[F.sum(c).alias(c) for c in parts.columns])
    grid = F.col("n_cycles") * F.col("n_keys")
    return j.select(
        "n_snapshot_rows", "n_cycles", "n_keys", "n_history_rows",
        (F.lit(1.0) - F.col("n_history_rows").cast("double") / grid.cast("double")).alias("grid_ratio"),
        (F.lit(1.0) - F.col("n_history_rows").cast("double") / F.col("n_snapshot_rows").cast("double")).alias("dense_ratio"),
    )


def rows_per_cycle(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """A5: messages and distinct keys per cycle."""
    return df.groupBy(spec.cycle).agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.countDistinct(*spec.keys).alias("n_keys"))


def recent(df: DataFrame, spec: FeedSpec, n: int = 20, cols: list[str] | None = None) -> DataFrame:
    """O1: the ``n`` most recent rows (ties by key) — a top-k, one bounded sort."""
    order = [F.col(spec.cycle).desc()] + [F.col(k).asc() for k in spec.keys]
    out = df.orderBy(*order).limit(n)
    return out.select(*cols) if cols else out
