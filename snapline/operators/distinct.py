"""Exact distinct counts that merge: a bitmap per day, kind and bucket of ids (A1, A2, A5).

Cycles and keys of any range of days are counted from the days' bitmaps, without the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapline.spec import FeedSpec

CYCLES, KEYS = "cycles", "keys"


def number_keys(df: DataFrame, spec: FeedSpec, known: DataFrame | None = None, buckets: int = 64) -> DataFrame:
    """``known`` (keys, id) with the keys of ``df`` that it lacks, numbered on from its largest id.

    New keys are numbered inside hash buckets; a bucket starts where the ones before it end, so no
    task holds all keys and ids stay dense. ``buckets`` grows with the number of keys of a feed.
    Rows with a null in their key have none. The ids of a stored dictionary never change; store it
    before the bitmaps made with it.
    """
    keys = spec.keys
    fresh = df.select(*keys).dropna().distinct()
    if known is not None:
        fresh = fresh.join(known, keys, "left_anti")
    b = fresh.withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)     # one row a bucket
    starts = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_b").orderBy(*keys)
    out = b.withColumn("_in", F.row_number().over(inside)).join(starts, "_b").select(
        *keys, (F.col("_start") + F.col("_in")).cast("long").alias("id"))
    if known is None:
        return out
    top = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return known.select(*keys, "id").unionByName(out.withColumn("id", F.col("id") + F.lit(top)))


def _cycle_id(c: Column) -> Column:
    """Whole seconds, from 1 on: positions of a bitmap start at 1, and epoch 0 is a cycle too."""
    return F.unix_seconds(c.cast("timestamp")) + 1


def day_bitmaps(rows: DataFrame, ids: DataFrame, spec: FeedSpec) -> DataFrame:
    """(date, kind, bucket, bitmap, n_rows): what :func:`distinct_counts` merges.

    Bitmaps are combined map-side, so a hot day or key shuffles a few kilobytes a task and bucket.
    Cycles count by the second and must not lie before 1970. ``n_rows`` stands beside the day's
    row of kind ``rows``, which has no bitmap; rows without a date are a day of their own (null).
    """
    named = rows.select(*spec.keys, spec.cycle, spec.date_col).join(ids, spec.keys, "left")
    pairs = named.select(spec.date_col, F.explode(F.array(
        F.struct(F.lit(CYCLES).alias("kind"), _cycle_id(F.col(spec.cycle)).alias("id")),
        F.struct(F.lit(KEYS).alias("kind"), F.col("id").alias("id")))).alias("p")).select(spec.date_col, "p.*")
    maps = (pairs.filter(F.col("id").isNotNull())
            .groupBy(spec.date_col, "kind", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")))
    counts = rows.groupBy(spec.date_col).agg(F.count(F.lit(1)).alias("n_rows"))
    return maps.withColumn("n_rows", F.lit(None).cast("long")).unionByName(counts.select(
        spec.date_col, F.lit("rows").alias("kind"), F.lit(0).cast("long").alias("bucket"),
        F.lit(None).cast("binary").alias("bitmap"), "n_rows"))


def distinct_counts(days: DataFrame, by: list[str]) -> DataFrame:
    """``n_cycles``, ``n_keys`` and ``n_rows`` for each value of ``by`` in a table of day bitmaps,
    in which a day may stand under several values (overlapping ranges)."""
    one = days.groupBy(*by, "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"), F.sum("n_rows").alias("r"))

    def total(kind: str, c: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(c))), F.lit(0)).cast("long")
    return one.groupBy(*by).agg(total(CYCLES, "n").alias("n_cycles"), total(KEYS, "n").alias("n_keys"),
                                total("rows", "r").alias("n_rows"))
