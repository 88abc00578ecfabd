"""Feed subscription (S1, S2) and topic watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Shape of a broker message as landed in files when no broker connector is present.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("value", T.StringType()),
])


def kafka_options(servers: str, topic: str, *, starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict:
    """S1/S2 option map: subscribe to one topic; ``latest`` on first start (resume is
    from the checkpoint), ``earliest`` to replay within retention; aged-out offsets are
    skipped (``failOnDataLoss=false``); a per-trigger cap bounds catch-up batches."""
    o = {"kafka.bootstrap.servers": servers, "subscribe": topic,
         "startingOffsets": starting, "failOnDataLoss": "false"}
    if max_offsets_per_trigger:
        o["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        o["minPartitions"] = str(min_partitions)
    return o


def open_feed(spark: SparkSession, kind: str, *, options: dict | None = None, path: str | None = None,
              streaming: bool = True, max_per_trigger: int | None = None) -> DataFrame:
    """Messages ``(value, timestamp, topic, partition, offset)`` from a broker topic
    (``kind="kafka"``, needs the Kafka connector on the classpath) or from JSON-lines
    files of landed messages (``kind="files"``)."""
    if kind == "kafka":
        r = (spark.readStream if streaming else spark.read).format("kafka").options(**(options or {}))
        df = r.load()
        return df.select(F.col("value").cast("string").alias("value"),
                         F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                         "topic", "partition", "offset")
    if kind == "files":
        r = spark.readStream if streaming else spark.read
        r = r.schema(MESSAGE_SCHEMA).options(**(options or {}))
        if streaming and max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        return r.json(path).select("value", "timestamp", "topic", "partition", "offset")
    raise ValueError(f"unknown feed kind {kind!r}")


def topic_watermarks(messages: DataFrame) -> DataFrame:
    """Per (topic, partition) the low/high watermarks and newest message time,
    from a batch read of the topic (``high`` = next offset to be written)."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
        F.max("timestamp").alias("last_ts"),
    )


def broker_summary(watermarks: DataFrame) -> DataFrame:
    """A4: topic and partition counts."""
    return watermarks.agg(F.countDistinct("topic").alias("topic_count"),
                          F.count(F.lit(1)).alias("partition_count"))
