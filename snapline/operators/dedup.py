"""Earliest-copy dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def dedup_earliest(df: DataFrame, keys: list[str] | tuple[str, ...], order: list[str] | tuple[str, ...]) -> DataFrame:
    """One row per ``keys``: the copy that is smallest by ``order`` (ascending, NULLs
    first), ties broken by the remaining columns so the result is deterministic.

    Written as an aggregation (``min`` of a struct) rather than ``row_number``: the
    partial aggregate collapses copies map-side, so a key holding a large share of all
    copies never reaches one task whole.
    """
    keys = list(keys)
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    winner = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    return (df.groupBy(*keys).agg(winner)
              .select(*keys, *[F.col("_w." + c).alias(c) for c in order + rest])
              .select(*df.columns))
