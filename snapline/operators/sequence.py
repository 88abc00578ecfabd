"""Skew-safe sequence primitives: previous/next row of the same key (``with_neighbor``)
and the as-of join (``asof_join``).

``lag``/``lead`` over ``partitionBy(key)`` sends a whole key to one task. Here the
order axis is cut into time buckets. Inside a ``(key, bucket)`` the neighbour comes
from a window on that pair. Only the first and last row of each bucket need a
neighbour from another bucket; those edge rows (at most two per bucket) form a
smaller sequence of the same shape, solved the same way with the next, coarser
bucket width. After the last width, a window over the key sees two rows per
coarsest bucket. Each level reads one shuffle for both of its branches (the plan
reuses the exchange), and the levels are unioned, with no join.

With widths (1 h, 1 d, 30 d), for example, a task never holds more than one key-hour
of rows, 48 edge rows of a key-day, 60 of a key-month, or two per key-month at the
top. After dedup, a key-hour holds at most one row per distinct cycle in that hour.
A key with a third of all rows is therefore spread over as many tasks as it has
buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def bucket_of(order: str, bucket_seconds: int) -> Column:
    micros = F.unix_micros(F.col(order).cast("timestamp"))
    return F.floor(micros / F.lit(bucket_seconds * 1_000_000))


def _resolve(df: DataFrame, keys: list[str], order: str, prev: bool, widths: list[int],
             name: str, depth: int) -> DataFrame:
    step = F.lag if prev else F.lead
    if not widths:
        return df.withColumn(name, step("_val").over(Window.partitionBy(*keys).orderBy(F.col(order))))
    first, last = f"_f{depth}", f"_l{depth}"
    inner = Window.partitionBy(*keys, "_bk").orderBy(F.col(order))
    x = df.withColumn("_bk", bucket_of(order, widths[0])).select(
        "*",
        step("_val").over(inner).alias(name),
        F.lag(F.lit(1)).over(inner).isNull().alias(first),
        F.lead(F.lit(1)).over(inner).isNull().alias(last),
    ).drop("_bk")
    needs = first if prev else last
    inside = x.filter(~F.col(needs)).drop(first, last)
    edges = x.filter(F.col(first) | F.col(last)).drop(name)
    solved = _resolve(edges, keys, order, prev, widths[1:], name, depth + 1)
    return inside.unionByName(solved.filter(F.col(needs)).drop(first, last))


def with_neighbor(df: DataFrame, keys: list[str], order: str, cols: list[str], *,
                  direction: str = "prev", buckets: Sequence[int] = (86400,),
                  name: str = "_nb") -> DataFrame:
    """Add struct column ``name`` with ``cols`` of the previous (``prev``) or next
    (``next``) row of the same key by ``order``; NULL for the first/last row.

    ``buckets`` are the bucket widths in seconds, finest first. ``(keys, order)``
    must be unique (dedup first). Rows without an ``order`` value have no neighbour and
    are nobody's neighbour.
    """
    x = df.withColumns({"_val": F.struct(*[F.col(c) for c in cols]), "_unordered": F.col(order).isNull()})
    out = _resolve(x, [*keys, "_unordered"], order, direction == "prev", list(buckets), name, 0)
    return out.withColumn(name, F.when(~F.col("_unordered"), F.col(name))).drop("_val", "_unordered")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str,
              cols: list[str], *, buckets: Sequence[int] = (86400,), name: str = "_asof") -> DataFrame:
    """For every ``left`` row, the ``cols`` (and time) of the newest ``right`` row of the
    same key with ``right_time <= left_time``, as struct column ``name`` (NULL if none).

    Both sides are unioned and cut into (key, bucket) groups. Inside a group the
    newest right row so far comes from a running ``last`` (ignoring left rows); the
    newest right row of earlier buckets comes from one aggregated row per (key,
    bucket), carried forward by a window over the key (one row per bucket), and is
    joined back on (key, bucket). No window ever spans a whole key's rows.
    """
    keys = list(keys)
    width = list(buckets)[0]
    val = F.struct(F.col("_t").alias(right_time), *[F.col(c) for c in cols])
    r = right.select(*keys, F.col(right_time).alias("_t"), *cols).select(
        *keys, "_t", F.lit(0).alias("_side"), val.alias("_v"))
    lcols = left.columns
    l = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_side"),
                    F.lit(None).cast(r.schema["_v"].dataType).alias("_v"),
                    F.struct(*[F.col(c) for c in lcols]).alias("_row"))
    u = r.withColumn("_row", F.lit(None).cast(l.schema["_row"].dataType)).unionByName(l)
    # Dealt out before the aggregation as for the window: combined where the sides come from, it would
    # sort all rows of a task first, and tasks of few compressed bytes can hold very many narrow rows.
    u = u.withColumn("_bk", bucket_of("_t", width)).repartition(*keys, "_bk")
    # right rows sort before left rows at the same time, so "<=" holds
    w = (Window.partitionBy(*keys, "_bk").orderBy("_t", "_side")
               .rowsBetween(Window.unboundedPreceding, 0))
    u = u.withColumn("_in", F.last("_v", ignorenulls=True).over(w))
    # one row per (key, bucket) present on either side; NULL where the bucket holds no right row
    newest = F.when(F.col("_side") == 0, F.struct(F.col("_t").alias("_o"), F.col("_v").alias("_x")))
    last = u.groupBy(*keys, "_bk").agg(F.max(newest).alias("_m"))
    carry = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    prior = last.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_bk").alias("_bk2"),
                        F.max("_m").over(carry)["_x"].alias("_cross"))
    lefts = u.filter(F.col("_side") == 1)
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col("_bk") == F.col("_bk2")]
    out = lefts.join(prior, cond, "left")
    return out.select(*[F.col("_row." + c).alias(c) for c in lcols],
                      F.coalesce("_in", "_cross").alias(name))
