"""The health check as one batch job: checkpoint offsets + topic state -> health rows.

Runs at an explicit ``as_of``. The live broker probe itself is not built; its results
enter as a table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from snapline.functions.cadence import Cadence
from snapline.operators.health import (broker_rows, controller_rows, producer_health, stream_health,
                                       with_expected)
from snapline.sources.feed import topic_watermarks
from snapline.sources.logs import checkpoint_offsets, kafka_partition_offsets


COMMITTED = "check_timestamp timestamp_ntz, stream string, partition int, committed long, commit_time timestamp_ntz"


def committed_offsets(spark: SparkSession, checkpoint: str, as_of: datetime) -> DataFrame:
    """Offsets of the newest batch in a Kafka stream's checkpoint, per topic partition,
    with the time the batch was planned (``check_timestamp`` = ``as_of``). A checkpoint
    that does not exist yet has committed nothing."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/offsets")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], COMMITTED)
    offs = kafka_partition_offsets(checkpoint_offsets(spark, checkpoint))
    newest = Window.partitionBy("topic", "partition")
    x = offs.withColumn("_last", F.max("batch_id").over(newest)).filter(F.col("batch_id") == F.col("_last"))
    return x.select(F.lit(as_of).cast("timestamp_ntz").alias("check_timestamp"),
                    F.col("topic").alias("stream"), F.col("partition").cast("int").alias("partition"),
                    F.col("offset").alias("committed"),
                    F.col("modified").cast("timestamp_ntz").alias("commit_time"))


def health_check(spark: SparkSession, checkpoint: str, messages: DataFrame, as_of: datetime, *,
                 topics: list[str] = (), probes: DataFrame | None = None,
                 producer_interval_seconds: int = 60, stream_threshold_seconds: float = 120,
                 cadence: Cadence = Cadence()) -> DataFrame:
    """Stream health (M2) and producer freshness (M3) rows at ``as_of``, and broker and
    controller rows (M4, J4) when a table of probe results is given.

    ``messages`` is a batch read of the topic (``topic, partition, offset, timestamp``); a
    bounded tail is enough, as the high watermark is the newest offset of a partition. Only
    messages at or before ``as_of`` count. Every topic of ``topics`` gets its two rows: one
    without a checkpoint or without a message is down.
    """
    at = F.lit(as_of).cast("timestamp_ntz")
    wm = topic_watermarks(messages.filter(F.col("timestamp") <= F.lit(as_of)))
    committed = committed_offsets(spark, checkpoint, as_of)
    last = wm.groupBy("topic").agg(F.max("last_ts").alias("last_ts"), F.max("high").alias("high")) \
             .withColumn("check_timestamp", at)
    if topics:
        expected = spark.createDataFrame([(t,) for t in topics], "topic string").withColumn("check_timestamp", at)
        committed = with_expected(committed, expected.withColumnRenamed("topic", "stream"),
                                  ["check_timestamp", "stream"])
        last = with_expected(last, expected, ["check_timestamp", "topic"])
    offsets = committed.join(
        wm.select(F.col("topic").alias("stream"), "partition", "high"), ["stream", "partition"], "left")
    rows = (stream_health(offsets, stream_threshold_seconds, cadence)
            .unionByName(producer_health(last, producer_interval_seconds, cadence)))
    if probes is None:
        return rows
    kafka = broker_rows(probes, cadence)
    return rows.unionByName(kafka.drop("controller_id")).unionByName(controller_rows(kafka))
