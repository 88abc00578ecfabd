"""Silver load per micro-batch (C3, T3, T5): type, dedup, change filter, insert-only merge."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F, types as T

from snapline.operators.change import batch_bounds, changes_as_of, changes_in_one_pass, changes_vs_state
from snapline.operators.dedup import dedup_earliest
from snapline.operators.envelope import apply_types, split_malformed
from snapline.operators.merge import BATCH_COL, history_schema, insert_only, write_history
from snapline.operators.state import last_known
from snapline.schemas import RAW_JSON_OPTIONS
from snapline.sources.raw import ACCEPTED, QUARANTINED, route_objects
from snapline.spec import FeedSpec, STATION_SPEC
from snapline.streaming.metrics import RunMetrics
from snapline.streaming.sinks import utc_now
from snapline.streaming.snapshots import drop_snapshots, known_rows, take_snapshot

STAMP = "silver_updated_at"


KEEP, DROP, QUARANTINE = "keep", "drop", "quarantine"


def stored_schema(batch: DataFrame, spec: FeedSpec) -> T.StructType:
    """Schema of the stored history for typed rows like ``batch``."""
    fields = history_schema(batch.schema, spec).fields
    if all(f.name != STAMP for f in fields):
        fields = [*fields[:-2], T.StructField(STAMP, T.TimestampNTZType()), *fields[-2:]]
    return T.StructType(fields)


def accept(raw: DataFrame, on_malformed: str, quarantine: str | None, batch_id: str) -> DataFrame:
    """Rows to load under the malformed-row policy: ``keep`` all, ``drop`` rows without any
    record field, or write them under ``quarantine``/batch_id=... and load the rest. But for
    ``keep``, ``raw`` is left persisted: the caller unpersists it after the load."""
    if on_malformed == KEEP:
        return raw
    if on_malformed not in (DROP, QUARANTINE):
        raise ValueError(f"unknown policy {on_malformed!r}")
    # Kept, so that a message is decoded once: a condition on decoded fields that reaches the scan
    # would decode it again for every field, and both halves would do so.
    good, bad = split_malformed(raw.persist())
    if on_malformed == QUARANTINE:
        if not quarantine:
            raise ValueError("quarantine needs a folder")
        bad.write.mode("overwrite").options(**RAW_JSON_OPTIONS).json(f"{quarantine.rstrip('/')}/batch_id={batch_id}")
    return good


def load_batch(raw: DataFrame, path: str, batch_id: str, spec: FeedSpec = STATION_SPEC, *,
               mode: str = "asof", lookback_days: int | None = -1, typed: bool = False,
               as_of: datetime | None = None, clock: Callable[[], datetime] = utc_now,
               on_malformed: str = KEEP, quarantine: str | None = None, state: str | None = None) -> int:
    """Load one raw batch into the history at ``path``; returns rows inserted.

    ``mode="asof"`` (C2): replay-safe, order-correct within the batch, which may span any time.
    ``mode="faithful"`` (C1): every batch row against the newest stored state per key
    (look-back from ``as_of``, default the batch's first cycle, no upper bound, as the
    reference does), then insert-only on ``(key, cycle)`` for the batch's dates. Replaying
    an old batch can then insert rows that were dropped the first time (hazard H3).
    The history is read without this batch id, so a retry recomputes the same rows
    and overwrites its own output. Rows without a cycle are stored too (they have no date),
    unless ``on_malformed`` turns them away (see :func:`accept`).

    With ``state``, a folder, state snapshots are kept there (``streaming/snapshots.py``): the load
    opens the newest one before its first day and the days since, not the whole look-back, and
    leaves one for the last day it closes. The rows stored are the same with or without.
    """
    if lookback_days == -1:
        lookback_days = spec.lookback_days
    rows, batch = raw, None
    try:
        if not typed:
            rows = apply_types(accept(raw, on_malformed, quarantine, batch_id), date_col=spec.date_col)
        batch = dedup_earliest(rows, spec.keys + [spec.cycle], spec.order).persist()
        lo, hi = batch_bounds(batch, spec)
        schema = stored_schema(batch, spec)
        if lo is None:
            return write_history(batch, path, spec, batch_id, as_of=clock())
        rows = _rows_to_store(batch, (lo, hi), path, schema, batch_id, spec, mode, lookback_days, as_of, state)
        if state:
            drop_snapshots(batch.sparkSession, state, lookback_days, lo.date())
        n = write_history(rows, path, spec, batch_id, as_of=clock())
        if state:
            take_snapshot(batch.sparkSession, path, schema, spec, state, lookback_days, hi.date() - timedelta(days=1))
        return n
    finally:
        if batch is not None:
            batch.unpersist()
        if not typed and on_malformed != KEEP:
            raw.unpersist()


def _rows_to_store(batch: DataFrame, bounds: tuple, path: str, schema: T.StructType, batch_id: str,
                   spec: FeedSpec, mode: str, lookback_days: int | None, as_of: datetime | None,
                   state: str | None) -> DataFrame:
    """Only the date folders that the look-back (or the days since a snapshot) can reach are read."""
    lo, hi = bounds
    if mode != "asof":
        return _faithful(batch, path, schema, batch_id, spec, lookback_days, as_of or lo, lo, state)
    hist = known_rows(batch.sparkSession, path, schema, spec, state, lookback_days, at=lo,
                      exclude_batch=batch_id, until=hi.date()).drop(STAMP, BATCH_COL)
    if lookback_days is None or hi - lo <= timedelta(days=lookback_days):
        return changes_as_of(batch, hist, spec, lookback_days, bounds=bounds)
    return changes_in_one_pass(batch, hist, spec, lookback_days, bounds=bounds)


def _faithful(batch: DataFrame, path: str, schema: T.StructType, batch_id: str, spec: FeedSpec,
              lookback_days: int | None, t0: datetime, lo: datetime, state: str | None) -> DataFrame:
    # The insert-only check needs the batch's dates, whatever the state is taken as of.
    hist = known_rows(batch.sparkSession, path, schema, spec, state, lookback_days, at=min(t0, lo),
                      exclude_batch=batch_id)
    last = last_known(hist, spec, as_of=t0, lookback_days=lookback_days, cols=list(spec.compared))
    cand = changes_vs_state(batch, last, spec)
    dates = [r[0] for r in batch.select(spec.date_col).distinct().collect() if r[0] is not None]
    return insert_only(cand, hist, spec, dates=dates)


def silver_sink(path: str, run_id: str, spec: FeedSpec = STATION_SPEC, *, mode: str = "asof",
                lookback_days: int | None = -1, typed: bool = False,
                clock: Callable[[], datetime] = utc_now, metrics: list | RunMetrics | None = None,
                on_malformed: str = KEEP, quarantine: str | None = None,
                prefix: str | None = None, state: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callable: micro-batches are loaded one after another (a
    stream runs its batches serially), batch id ``<run_id>-<epoch>``.

    With ``prefix`` (S4, P6, P7) each row's ``source_file`` is routed by its name from the
    prefix on: files that are not landed objects are ignored, misplaced ones go to
    ``quarantine`` or, without it, are left out."""

    def run(df: DataFrame, epoch_id: int) -> None:
        batch_id = f"{run_id}-{epoch_id:06d}"
        if prefix is not None:
            name = F.when(F.col("source_file").contains(f"/{prefix}"), F.concat(
                F.lit(prefix), F.substring_index("source_file", f"/{prefix}", -1))).otherwise(F.col("source_file"))
            routed = route_objects(df.withColumn("_object", name), "_object", prefix)
            if quarantine:
                (routed.filter(F.col("route") == QUARANTINED).drop("_object", "route", "batch_date")
                 .write.mode("overwrite").options(**RAW_JSON_OPTIONS)
                 .json(f"{quarantine.rstrip('/')}/misplaced/batch_id={batch_id}"))
            df = routed.filter(F.col("route") == ACCEPTED).drop("_object", "route", "batch_date", "source_file")
        n = load_batch(df, path, batch_id, spec, mode=mode, lookback_days=lookback_days, typed=typed,
                       clock=clock, on_malformed=on_malformed, quarantine=quarantine, state=state)
        if metrics is not None:
            metrics.append((epoch_id, n))

    return run


def load_files_in_order(spark, day_dirs: list[str], path: str, run_id: str,
                        spec: FeedSpec = STATION_SPEC, **kw) -> list[int]:
    """Batch fold: load raw folders one by one (what the stream does, without it)."""
    from snapline.sources.raw import read_raw
    return [load_batch(read_raw(spark, d), path, f"{run_id}-{i:06d}", spec, **kw)
            for i, d in enumerate(day_dirs)]
