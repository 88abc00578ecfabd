"""Retention of date partitions (K6)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from snapline.operators.merge import NULL_PARTITION


def expired_partitions(df: DataFrame, date_col: str, as_of: date, days: int) -> DataFrame:
    """Per partition date: rows held and whether it is past retention
    (``date < as_of - days``). On a partitioned table the counts come from the
    partition column alone; dropping is then a metadata operation per listed date."""
    cutoff = as_of - timedelta(days=days)
    return (df.groupBy(F.col(date_col)).agg(F.count(F.lit(1)).alias("n_rows"))
              .withColumn("expired", F.col(date_col) < F.lit(cutoff)))


def drop_expired(spark, table_name: str, date_col: str, as_of: date, days: int) -> list[date]:
    """Drop expired partitions of a catalog table (metadata operation per date). The
    list of partition dates comes from the catalog, bounded by the number of partitions."""
    cutoff = as_of - timedelta(days=days)
    parts = spark.sql(f"SHOW PARTITIONS {table_name}").collect()
    dropped = []
    for r in parts:
        spec = dict(kv.split("=", 1) for kv in r[0].split("/"))
        if spec[date_col] == NULL_PARTITION:
            continue
        d = date.fromisoformat(spec[date_col])
        if d < cutoff:
            spark.sql(f"ALTER TABLE {table_name} DROP IF EXISTS PARTITION ({date_col} = DATE'{d}')")
            dropped.append(d)
    return dropped


def drop_expired_paths(spark, path: str, date_col: str, as_of: date, days: int) -> list[date]:
    """Path-based variant: delete ``date_col=...`` folders older than the retention."""
    from snapline.operators.merge import _fs, partition_dirs
    cutoff = as_of - timedelta(days=days)
    dropped = []
    for value, full in partition_dirs(spark, path, date_col):
        if value is None:                 # rows without a date never expire
            continue
        d = date.fromisoformat(value)
        if d < cutoff:
            fs, p = _fs(spark, full)
            fs.delete(p, True)
            dropped.append(d)
    return sorted(dropped)
