"""Greedy selection by a minimum gap: each kept row says when the next one may come.

The first row of a key is kept; then, from every kept row on, the first row at or after that
row's ``until``. A choice depends on the one before it, so a plain window cannot make it, and
walking a key row by row would put a hot key into one task. Here a key's time line is cut into
blocks, and what a block does is composed:

1. inside a (key, block), every row learns where the chain through it leaves the block;
2. that leads to the first row of a later block, found by an as-of join: an *entry*;
3. entries point to entries, and the ones reached from the key's first row are marked by
   doubling: after k rounds, all within 2**k blocks. Rounds are the logarithm of the blocks a
   chain crosses, over entries only;
4. every block that was entered walks its chain from its one entry.

A task holds one Arrow batch and one (key, block) at a time; rows are shuffled narrow, a fixed
number of times. Steps 1 and 4 run Python in tasks (a chain through a block is no window function),
a call per batch, as there may be very many small blocks; every step's result is a table in the
shared folder, so what callers go on with is a plain read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from snapline.operators.sequence import asof_join
from snapline.session import checkpoint_dir


def _cut(df: DataFrame, name: str) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(keys: Sequence[str], a: DataFrame, b: DataFrame) -> list[Column]:
    return [a[k].eqNullSafe(b[f"{k}__r"]) for k in keys]


def _right(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"{k}__r" for k in keys})


def _per_block(df: DataFrame, keys: Sequence[str], fn: Callable) -> DataFrame:
    """``fn(rows, starts)`` over the rows of whole (keys, _bk) blocks, sorted by ``_t``; ``starts``
    has where each block begins, and the number of rows. The schema stays."""
    by = [*keys, "_bk"]

    def run(batches):
        import numpy as np
        rest = []
        for pdf in batches:
            pdf = pd.concat([*rest, pdf], ignore_index=True)
            new = np.zeros(len(pdf), bool)
            for c in by:
                was = pdf[c].shift()
                new |= (pdf[c].ne(was) & ~(pdf[c].isna() & was.isna())).to_numpy()
            new[:1] = True
            starts = np.flatnonzero(new)                     # the last block may go on in the next batch
            if len(starts) > 1:
                yield fn(pdf.iloc[:starts[-1]].copy(), starts)
            rest = [pdf.iloc[starts[-1]:]] if len(starts) else []
        if rest:
            yield fn(rest[0].copy(), np.array([0, len(rest[0])]))

    return df.repartition(*by).sortWithinPartitions(*by, "_t").mapInPandas(run, df.schema)


def spaced(df: DataFrame, keys: Sequence[str], order: str, until: Column, *, block_seconds: int) -> DataFrame:
    """(keys, order) of the kept rows of ``df``: per key the first row by ``order``, then always
    the first row at or after the ``until`` (a later time) of the row kept before.

    Rows without an order are left out; a null key is a key; of rows that share (key, order) the
    earliest ``until`` counts. ``block_seconds`` should span several gaps, and bounds what one task
    holds of a key. An empty input gives an empty result.
    """
    keys = list(keys)
    order_type = df.schema[order].dataType
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    rows = (df.filter(F.col(order).isNotNull())
            .select(*keys, micros(F.col(order)).alias("_t"), micros(until).alias("_u"))
            .groupBy(*keys, "_t").agg(F.min("_u").alias("_u"))
            .withColumns({"_u": F.greatest("_u", F.col("_t") + 1),
                          "_bk": F.floor(F.col("_t") / F.lit(block_seconds * 1_000_000))}))

    def leave(pdf: pd.DataFrame, starts) -> pd.DataFrame:
        import numpy as np
        t, u = pdf["_t"].to_numpy(), pdf["_u"].to_numpy().copy()
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a == 1:
                continue
            to = np.searchsorted(t[a:b], u[a:b])
            to = np.where(to < b - a, to, np.arange(b - a))       # the block's last of a chain stays
            while True:
                further = to[to]
                if (further == to).all():
                    break
                to = further
            u[a:b] = u[a:b][to]
        pdf["_u"] = u
        return pdf

    left = _cut(_per_block(rows, keys, leave), "spacing-blocks")

    # The first row at or after a time is, on the reversed time line, the newest row not after it.
    back = lambda c: F.timestamp_micros(-F.col(c))
    exits = left.select(*keys, "_u").distinct().withColumn("_at", back("_u"))
    hits = asof_join(exits, left.select(*keys, F.col("_t").alias("_first"), back("_t").alias("_was")), keys, "_at",
                     "_was", ["_first"], buckets=(block_seconds,), name="_hit")
    hits = _cut(hits.select(*keys, "_u", F.col("_hit._first").alias("_to")).filter(F.col("_to").isNotNull()), "spacing-exits")
    first = left.groupBy(*keys).agg(F.min("_t").alias("_t"))
    entries = hits.select(*keys, F.col("_to").alias("_t")).unionByName(first).distinct()
    e = _right(entries, keys).withColumnRenamed("_t", "_e")
    entry = left.join(e, [*_same(keys, left, e), left["_t"] == e["_e"]], "left_semi")
    h = _right(hits, keys).withColumnRenamed("_u", "_hu")
    step = _cut(entry.join(h, [*_same(keys, entry, h), entry["_u"] == h["_hu"]]).select(*keys, "_t", "_to"), "spacing-steps")

    reached = _cut(first, "spacing-reached")
    while not step.isEmpty():
        s = _right(step, keys).withColumnRenamed("_t", "_s")
        more = reached.join(s, [*_same(keys, reached, s), reached["_t"] == s["_s"]]).select(*keys, F.col("_to").alias("_t"))
        reached = _cut(reached.unionByName(more).distinct(), "spacing-reached")
        step = _cut(step.withColumnRenamed("_to", "_via").join(
            s, [*[F.col(k).eqNullSafe(F.col(f"{k}__r")) for k in keys], F.col("_via") == F.col("_s")])
            .select(*keys, "_t", "_to"), "spacing-steps")

    block = F.floor(F.col("_t") / F.lit(block_seconds * 1_000_000))
    entered = _right(reached.withColumn("_bk", block), [*keys, "_bk"]).withColumnRenamed("_t", "_from")
    inside = rows.join(entered, _same([*keys, "_bk"], rows, entered)).filter(F.col("_t") >= F.col("_from")).select(
        *keys, "_bk", "_t", "_u")

    def walk(pdf: pd.DataFrame, starts) -> pd.DataFrame:
        import numpy as np
        t, u, kept = pdf["_t"].to_numpy(), pdf["_u"].to_numpy(), []
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a == 1:
                kept.append(a)
                continue
            to, at = np.searchsorted(t[a:b], u[a:b]), 0
            while at < b - a:
                kept.append(a + at)
                at = int(to[at])
        return pdf.iloc[kept]

    kept = _per_block(inside, keys, walk)
    return _cut(kept.select(*keys, F.timestamp_micros("_t").cast(order_type).alias(order)), "spacing-kept")
