"""State snapshots beside the history (W2, J1): a load opens one narrow row per key and the days since.

Without them, every load reads the whole look-back to learn each key's last stored row. A snapshot
holds that row for all days up to and including its own; it is folded from the snapshot before it
and the days between, so building one reads no look-back either.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapline.operators.merge import _fs, partition_dirs, read_history
from snapline.operators.state import latest_per_key
from snapline.spec import FeedSpec

UPTO = "upto"


def _folder(state: str, lookback_days: int | None) -> str:
    """Snapshots leave out what the look-back has passed, so each look-back has its own."""
    return f"{state.rstrip('/')}/lookback={'none' if lookback_days is None else lookback_days}"


def snapshots(spark: SparkSession, state: str, lookback_days: int | None) -> list[tuple[date, str]]:
    """Stored snapshots, oldest first (a listing of folder names)."""
    return sorted((date.fromisoformat(v), p) for v, p in
                  partition_dirs(spark, _folder(state, lookback_days), UPTO) if v is not None)


def _columns(schema: T.StructType, spec: FeedSpec) -> T.StructType:
    names = [*spec.keys, spec.cycle, *spec.compared, spec.date_col]
    return T.StructType([schema[n] for n in dict.fromkeys(names)])


def known_rows(spark: SparkSession, path: str, schema: T.StructType, spec: FeedSpec, state: str | None,
               lookback_days: int | None, *, at: datetime, exclude_batch: str | None = None,
               until: date | None = None) -> DataFrame:
    """Stored rows that can matter to rows from ``at`` on: the newest snapshot that ends before
    the day of ``at`` together with the history after it, or the look-back's days of the history
    if there is none. Of the days a snapshot covers, each key has its newest row only.

    A batch is not in a snapshot that ends before the batch's first day, so ``exclude_batch``
    (a retry's own id) needs a filter on the days after the snapshot only.
    """
    since = None if lookback_days is None else (at - timedelta(days=lookback_days)).date()
    usable = [s for s in snapshots(spark, state, lookback_days) if s[0] < at.date()] if state else []
    if not usable or (since is not None and usable[-1][0] < since):
        return read_history(spark, path, schema, spec, exclude_batch=exclude_batch, since=since, until=until)
    upto, folder = usable[-1]
    later = read_history(spark, path, schema, spec, exclude_batch=exclude_batch,
                         since=upto + timedelta(days=1), until=until)
    held = spark.read.schema(_columns(schema, spec)).parquet(folder)
    return later.unionByName(held, allowMissingColumns=True)


def drop_snapshots(spark: SparkSession, state: str, lookback_days: int | None, since: date) -> None:
    """Remove the snapshots that cover ``since`` or later: the history of those days changes.
    Every load calls it before it writes, so that no snapshot outlives the rows it was made of;
    whoever rewrites days by other means (late-row repair, retention by hand) calls it too."""
    for upto, folder in snapshots(spark, state, lookback_days):
        if upto >= since:
            fs, p = _fs(spark, folder)
            fs.delete(p, True)


def take_snapshot(spark: SparkSession, path: str, schema: T.StructType, spec: FeedSpec, state: str,
                  lookback_days: int | None, upto: date, keep: int = 3) -> bool:
    """Store the state at the end of ``upto``, folded from the newest snapshot before it and the
    days since; false if it is there already. Rows that the look-back has passed by then are left
    out. The folder is renamed into place when it is complete, and only the ``keep`` newest
    snapshots stay."""
    have = snapshots(spark, state, lookback_days)
    if any(d == upto for d, _ in have):
        return False
    end = datetime(upto.year, upto.month, upto.day) + timedelta(days=1)
    rows = known_rows(spark, path, schema, spec, state, lookback_days, at=end, until=upto)
    rows = rows.filter(F.col(spec.date_col) <= F.lit(upto))
    if lookback_days is not None:
        rows = rows.filter(F.col(spec.cycle) >= F.lit(end - timedelta(days=lookback_days)))
    names = _columns(schema, spec).names
    last = latest_per_key(rows.select(*names), spec.keys, spec.cycle, names).select(*names)
    root = _folder(state, lookback_days)
    fs, staged = _fs(spark, f"{root}/_new/{upto}")
    last.write.mode("overwrite").parquet(f"{root}/_new/{upto}")
    fs.rename(staged, _fs(spark, f"{root}/{UPTO}={upto}")[1])
    for _, folder in [s for s in have if s[0] < upto][:-(keep - 1) or None]:
        fs.delete(_fs(spark, folder)[1], True)
    return True
