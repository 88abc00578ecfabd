"""History as a bucketed table: insert-only merges that never shuffle the stored rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from snapline.operators.merge import BATCH_COL, _fs, insert_only, observed_rows
from snapline.spec import FeedSpec


def open_bucketed(spark: SparkSession, name: str, path: str, schema: T.StructType, spec: FeedSpec,
                  buckets: int) -> None:
    """Register the table ``name`` over ``path``, with the partitions already stored there.

    ``schema`` is the history's (see ``history_schema``). Rows lie under ``(date, batch_id)``, in
    ``buckets`` files by a hash of (key, cycle), sorted by them: a key that holds a third of all
    rows spreads over every bucket. ``buckets`` is a property of the stored files; a table is
    always opened with the number it was written with. As a bucket is read by one task across
    the dates of a merge, choose it so that those dates divide into tasks of a few hundred MB.
    """
    fs, root = _fs(spark, path)
    fs.mkdirs(root)
    quoted = lambda cols: ", ".join(f"`{c}`" for c in cols)
    by = quoted(spec.keys + [spec.cycle])
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"OPTIONS (partitionOverwriteMode 'dynamic') "
              f"PARTITIONED BY ({quoted([spec.date_col, BATCH_COL])}) "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(int(r["data_type"]) for r in rows if r["col_name"] == "Num Buckets")


def new_rows(batch: DataFrame, name: str, spec: FeedSpec, batch_id: str,
             dates: list[date] | None = None) -> DataFrame:
    """Rows of ``batch`` whose (key, cycle) the table does not hold.

    The batch is dealt to the table's buckets and met there by the stored files, which are
    neither shuffled nor, with ``dates``, read beyond the batch's partitions. Rows stored by an
    earlier attempt of the same ``batch_id`` do not count. Rows with a null key or cycle match nothing.
    """
    spark = batch.sparkSession
    stored = spark.table(name).filter(F.col(BATCH_COL) != F.lit(batch_id))
    dealt = batch.repartition(_buckets(spark, name), *spec.keys, spec.cycle)
    return insert_only(dealt, stored, spec, dates)


def merge_bucketed(batch: DataFrame, name: str, spec: FeedSpec, batch_id: str) -> int:
    """K4/K7: insert the rows of ``batch`` that are new, under ``batch_id``; returns their number.

    Files are written where the join left the rows, one per bucket and date. A repeated batch id
    replaces exactly its own folders in the dates it writes (dynamic overwrite), so a retry adds
    nothing. Rows without a date go to the partition of null. An empty batch writes nothing.
    """
    spark = batch.sparkSession
    dates = [r[0] for r in batch.select(spec.date_col).distinct().collect() if r[0] is not None]
    obs = Observation()
    out = (new_rows(batch, name, spec, batch_id, dates).withColumn(BATCH_COL, F.lit(batch_id))
           .select(*spark.table(name).columns).observe(obs, F.count(F.lit(1)).alias("rows")))
    out.write.insertInto(name, overwrite=True)
    return observed_rows(obs)
