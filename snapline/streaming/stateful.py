"""Stateful change filter (T9): last kept state per key in the state store.

Each key's state holds the compared values (as JSON text) and cycle of its last kept row and the
newest cycle seen. The state is O(1) per key. A call of the fold costs milliseconds besides its
rows, so with many small keys ``groups`` lets the keys of one hash share a call and a state row;
without it every key has its own. One call receives its keys' rows of one micro-batch: at most
as many as the source's per-trigger cap (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) lets
in, so set that cap for the memory of one task; a key's history never passes through a task whole.
Within a micro-batch a key's rows are folded in cycle order, so the
look-back expiry is exact per row (event time, not wall clock): a row is kept when it
is the key's first, when the last kept row is more than N days older, or when a
compared field differs. Copies of an already seen cycle are dropped; a late row (older
than the newest seen) is compared with the newest state, as the batch loader does.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from snapline.schemas import RAW_JSON_OPTIONS
from snapline.spec import FeedSpec

DAY_MICROS = 86_400_000_000


def _text(schema: T.StructType, cols) -> Column:
    """The values of ``cols`` as one text, equal for equal values (null-safe, -0.0 as 0.0)."""
    plain = lambda c: F.col(c) + F.lit(0.0).cast(schema[c].dataType) \
        if isinstance(schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)
    return F.to_json(F.struct(*[plain(c).alias(c) for c in cols]), RAW_JSON_OPTIONS)


def fold_keys(pdf, spec: FeedSpec, lookback_days: int | None, known: dict) -> list:
    """Fold the rows of some keys (a pandas frame with ``_key`` and ``_vals`` texts) against
    ``known``, key -> [values, last kept, last seen] in microseconds, which is brought up to date.
    Returns the kept rows.
    """
    import pandas as pd
    pdf = pdf.sort_values(["_key", spec.cycle, *spec.order], na_position="first", kind="mergesort", ignore_index=True)
    undated = pdf[spec.cycle].isna().tolist()
    times = pd.to_datetime(pdf[spec.cycle]).to_numpy("datetime64[us]").astype("int64").tolist()
    horizon = None if lookback_days is None else lookback_days * DAY_MICROS
    kept, at, before, vals, last, seen, newest = [], None, None, None, None, None, None
    for i, (key, none, t, v) in enumerate(zip(pdf["_key"].tolist(), undated, times, pdf["_vals"].tolist())):
        if key != at or i == 0:
            at, before, newest = key, known.get(key), None
            vals, last, seen = before or (None, None, None)
        elif t == newest:                   # a copy of the row before (undated rows share one value)
            continue
        newest = t
        if none:
            kept.append(i)
        elif before is not None and t <= before[2]:
            # Late rows meet the state as it is before this batch; copies of its cycle are dropped.
            if t < before[2] and (v != before[0] or horizon is not None and before[1] < t - horizon):
                kept.append(i)
        else:
            if seen is None or v != vals or horizon is not None and last < t - horizon:
                kept.append(i)
                vals, last = v, t
            seen = t
            known[key] = [vals, last, seen]
    return pdf.iloc[kept]


def stateful_changes(stream: DataFrame, spec: FeedSpec, lookback_days: int | None = -1,
                     watermark_delay: str | None = None, groups: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed rows -> streaming DataFrame of kept rows.

    With a look-back and ``watermark_delay`` the state of a key is evicted once event
    time (the watermark on the cycle) passes its last kept cycle plus the look-back.
    Any later on-time row would be re-emitted anyway, so the result is unchanged and
    state holds only keys seen within the look-back. Rows older than the watermark
    are dropped by Spark.

    ``groups`` deals the keys by hash to so many state rows, about a hundred keys each for
    small keys; it must stay the same as long as a checkpoint lives.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    from snapline.session import ship_package
    ship_package(stream.sparkSession)
    evict = watermark_delay is not None and lookback_days is not None
    if evict:
        stream = (stream.withColumn("_event_time", F.col(spec.cycle).cast("timestamp"))
                        .withWatermark("_event_time", watermark_delay))
    schema = stream.schema
    horizon_ms = None if lookback_days is None else lookback_days * 86_400_000
    x = stream.withColumns({"_key": _text(schema, spec.keys), "_vals": _text(schema, spec.compared)})
    by = list(spec.keys)
    if groups:
        x, by = x.withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(groups))), ["_group"]

    def put(state, known):
        """Write the keys that are still within the look-back, and when the next one leaves it."""
        now = state.getCurrentWatermarkMs() if evict else None
        if evict:
            known = {k: s for k, s in known.items() if s[1] // 1000 + horizon_ms >= now}
        if not known:
            if state.exists:
                state.remove()
            return
        state.update((json.dumps(known),))
        if evict:
            state.setTimeoutTimestamp(min(s[1] for s in known.values()) // 1000 + horizon_ms)

    def fn(_, pdfs, state):
        import pandas as pd
        known = json.loads(state.get[0]) if state.exists else {}
        if state.hasTimedOut:
            put(state, known)
            return
        kept = fold_keys(pd.concat(list(pdfs), ignore_index=True), spec, lookback_days, known)
        put(state, known)
        yield kept[schema.names]

    out = x.groupBy(*by).applyInPandasWithState(
        fn, schema, "known string", "append",
        GroupStateTimeout.EventTimeTimeout if evict else GroupStateTimeout.NoTimeout)
    return out.drop("_event_time") if evict else out
