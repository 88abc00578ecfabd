"""Insert-only merge into a date-partitioned history."""

from __future__ import annotations

from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from snapline.spec import FeedSpec

BATCH_COL = "batch_id"


def insert_only(batch: DataFrame, target: DataFrame, spec: FeedSpec,
                dates: list[date] | None = None) -> DataFrame:
    """Rows of ``batch`` whose ``(key, cycle)`` is not in ``target``.

    ``dates`` (the batch's partition dates) bounds the target scan; without it the
    anti-join reads the target's matching keys wherever they are.
    """
    t = target
    if dates is not None and spec.date_col in t.columns:
        t = t.filter(F.col(spec.date_col).isin(list(dates)))
    return batch.join(t.select(*spec.keys, spec.cycle), spec.keys + [spec.cycle], "left_anti")


def layout(df: DataFrame, spec: FeedSpec, by_range: bool = False) -> DataFrame:
    """K4: cluster rows by date and sort inside files by key so parquet row-group
    statistics skip by key.

    Rows are rebalanced by date: AQE splits a large date into tasks of its advisory size,
    wherever its rows come from, and puts small dates together. A write thus leaves files of
    that size, one or few a date, not one per date and shuffle partition. No sampling job is
    needed, which suits micro-batches. ``by_range`` range-partitions on (date, key, cycle)
    instead, for large backfills where contiguous files per date matter.
    """
    keys = [F.col(k) for k in spec.keys]
    if by_range:
        parted = df.repartitionByRange(F.col(spec.date_col), *keys, F.col(spec.cycle))
    else:
        parted = df.hint("rebalance", spec.date_col)
    return parted.sortWithinPartitions(spec.date_col, *spec.keys, spec.cycle)


def history_schema(df_schema: T.StructType, spec: FeedSpec) -> T.StructType:
    fields = [f for f in df_schema.fields if f.name not in (spec.date_col, BATCH_COL)]
    return T.StructType(fields + [T.StructField(spec.date_col, T.DateType()),
                                  T.StructField(BATCH_COL, T.StringType())])


def read_history(spark: SparkSession, path: str, schema: T.StructType, spec: FeedSpec,
                 exclude_batch: str | None = None, since: date | None = None,
                 until: date | None = None) -> DataFrame:
    """The stored history with an explicit schema (no partition type inference);
    an absent table reads as empty. Callers add date filters; they reach the scan as
    partition filters.

    With ``since``/``until`` only the date folders in that range are listed and read
    (one listing of the top level), so the cost of opening the table does not grow with
    the number of stored dates and batches. Rows without a cycle have no date and are
    outside every range."""
    if since is not None or until is not None:
        dirs = [full for value, full in partition_dirs(spark, path, spec.date_col)
                if value is not None and (since is None or date.fromisoformat(value) >= since)
                and (until is None or date.fromisoformat(value) <= until)]
        if not dirs:
            return spark.createDataFrame([], schema)
        df = spark.read.schema(schema).option("basePath", path).parquet(*dirs)
        if exclude_batch is not None:
            df = df.filter(F.col(BATCH_COL) != F.lit(exclude_batch))
        return df
    try:
        df = spark.read.schema(schema).parquet(path)
    except Exception as e:  # path does not exist yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    if exclude_batch is not None:
        df = df.filter(F.col(BATCH_COL) != F.lit(exclude_batch))
    return df


def observed_rows(obs: Observation) -> int:
    """The observed number of rows of a write that has ended."""
    try:
        return int(obs.get.get("rows", 0))
    except Py4JJavaError as e:
        # The plan was folded to an empty one at run time: nothing was observed, nothing written.
        if "assertion failed" not in str(e.java_exception):
            raise
        return 0


def write_history(df: DataFrame, path: str, spec: FeedSpec, batch_id: str | Column,
                  as_of: datetime | None = None, stamp_col: str | None = "silver_updated_at") -> int:
    """Append one batch's rows, replay-safe: output lives under ``(date, batch_id)``
    and is written with dynamic partition overwrite, so a retry of the same batch id
    replaces exactly its own files. ``batch_id`` may be a column, for several batches in
    one write. Returns the number of rows written (K11), counted with an observation
    during the write (no second job).
    """
    obs = Observation()
    stamped = df
    if stamp_col:
        stamp = F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()
        stamped = df.withColumn(stamp_col, stamp)
    out = stamped.withColumn(BATCH_COL, batch_id if isinstance(batch_id, Column) else F.lit(batch_id)).observe(obs, F.count(F.lit(1)).alias("rows"))
    (layout(out, spec).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(spec.date_col, BATCH_COL)
        .parquet(path))
    return observed_rows(obs)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# Fixed value: the folder Spark writes rows with a NULL partition value to.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_dirs(spark: SparkSession, path: str, column: str) -> list[tuple[str | None, str]]:
    """``(value, full path)`` of the ``column=value`` folders directly under ``path``
    (a listing of folder names, bounded by the number of partitions); value None is the
    folder of rows without one."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(column + "="):
            value = name.split("=", 1)[1]
            out.append((None if value == NULL_PARTITION else value, st.getPath().toString()))
    return out


def replace_dates(rows: DataFrame, path: str, spec: FeedSpec, dates: list[date], batch_id: str) -> None:
    """Make ``rows`` the whole content of the history's ``dates``, under one batch folder a date.

    The new folders are written beside the table (``<path>/_swap/<batch_id>``, hidden from
    readers); once all of them stand, a marker says so, and only then date after date is swapped:
    the old folder is renamed out of the table, the new one into it. A date is never read twice
    over. A job that dies before the marker has changed nothing; one that dies after it is
    finished by :func:`finish_swaps`, which every load that replaces dates runs first.
    """
    spark = rows.sparkSession
    stage = f"{path.rstrip('/')}/_swap/{batch_id}"
    fs, root = _fs(spark, stage)
    fs.delete(root, True)
    staged = rows.withColumn(BATCH_COL, F.lit(batch_id))
    layout(staged, spec).write.partitionBy(spec.date_col, BATCH_COL).parquet(stage)
    for d in dates:                                # a date left without rows is swapped for an empty one
        fs.mkdirs(_fs(spark, f"{stage}/{spec.date_col}={d}")[1])
    fs.create(_fs(spark, f"{stage}/_ready")[1], True).close()
    finish_swaps(spark, path, spec)


def finish_swaps(spark: SparkSession, path: str, spec: FeedSpec) -> None:
    """Complete the swaps of :func:`replace_dates` that were ready, and drop those that were not."""
    fs, root = _fs(spark, f"{path.rstrip('/')}/_swap")
    if not fs.exists(root):
        return
    for st in fs.listStatus(root):
        stage = st.getPath().toString()
        if fs.exists(_fs(spark, f"{stage}/_ready")[1]):
            for value, full in partition_dirs(spark, stage, spec.date_col):
                live = f"{path.rstrip('/')}/{spec.date_col}={value}"
                old = _fs(spark, f"{stage}/_old-{value}")[1]
                # A swap that died between its renames left the old folder out already.
                if fs.exists(_fs(spark, live)[1]) and not fs.exists(old):
                    fs.rename(_fs(spark, live)[1], old)
                fs.rename(_fs(spark, full)[1], _fs(spark, live)[1])
                fs.delete(old, True)
        fs.delete(st.getPath(), True)
    fs.delete(root, True)


def compact_dates(spark: SparkSession, path: str, schema: T.StructType, spec: FeedSpec,
                  dates: list[date]) -> int:
    """Rewrite each closed date's per-batch folders as one folder ``batch_id=compact``.

    One write covers all the dates: their rows are deduplicated on ``(key, cycle)``
    (stored copies are identical), then the dates are swapped (see :func:`replace_dates`): no
    reader sees a row twice, and an interrupted compaction is finished by the next one.
    Returns the rows in the compacted dates.
    """
    from snapline.operators.dedup import dedup_earliest
    if not dates:
        return 0
    finish_swaps(spark, path, spec)
    rows = read_history(spark, path, schema, spec, since=min(dates), until=max(dates)) \
        .filter(F.col(spec.date_col).isin(list(dates)))
    cols = [c for c in rows.columns if c != BATCH_COL]
    one = dedup_earliest(rows.select(*cols), spec.keys + [spec.cycle], [])
    stored = {value for value, _ in partition_dirs(spark, path, spec.date_col)}
    replace_dates(one, path, spec, [d for d in dates if str(d) in stored], "compact")
    return read_history(spark, path, schema, spec, since=min(dates), until=max(dates)) \
        .filter(F.col(spec.date_col).isin(list(dates))).count()
