"""What a stream has committed: its checkpoint's offsets (S7, A3) and its sink's files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per (batch, source) of ``<checkpoint>/offsets/<batchId>``: line 1 is the
    version, line 2 the batch metadata, then one offset JSON per source. Kafka offsets
    (``{"topic":{"partition":offset}}``) are exploded to ``topic, partition, offset``;
    file sources give ``log_offset``."""
    raw = (spark.read.text(f"{checkpoint.rstrip('/')}/offsets", wholetext=True)
           .select(F.col("_metadata.file_name").alias("name"),
                   F.col("_metadata.file_modification_time").alias("modified"),
                   F.split(F.col("value"), "\n").alias("lines"))
           .filter(F.col("name").rlike(r"^[0-9]+$")))
    meta = F.from_json(F.col("lines")[1], "batchWatermarkMs long, batchTimestampMs long")
    per_source = raw.select(
        F.col("name").cast("long").alias("batch_id"), "modified",
        meta["batchTimestampMs"].alias("batch_timestamp_ms"),
        F.posexplode(F.slice("lines", F.lit(3), F.size("lines"))).alias("source_index", "offset_json"))
    per_source = per_source.filter(F.length("offset_json") > 0)
    kafka = F.from_json("offset_json", "map<string, map<string, long>>")
    return per_source.select(
        "batch_id", "modified", "batch_timestamp_ms", "source_index", "offset_json",
        F.get_json_object("offset_json", "$.logOffset").cast("long").alias("log_offset"),
        kafka.alias("kafka_offsets"))


def kafka_partition_offsets(offsets: DataFrame) -> DataFrame:
    """Explode Kafka offsets to ``batch_id, topic, partition, offset``."""
    t = offsets.select("batch_id", "modified", F.explode_outer("kafka_offsets").alias("topic", "parts"))
    return t.select("batch_id", "modified", "topic",
                    F.explode_outer("parts").alias("partition", "offset"))


def latest_batch(offsets: DataFrame) -> DataFrame:
    """A3: newest batch id with its file time (``max_by`` over numeric names)."""
    return offsets.agg(F.max("batch_id").alias("batch_id"),
                       F.max_by("modified", "batch_id").alias("modified"))


def committed_files(spark: SparkSession, out_dir: str, schema: T.StructType, **options: str) -> DataFrame:
    """Files a file sink has committed, with their size and rows. Spark's reader of the
    folder honours the sink's commit log, compacted or not."""
    rows = spark.read.schema(schema).options(**options).json(out_dir)
    return rows.groupBy(F.col("_metadata.file_path").alias("path"),
                        F.col("_metadata.file_size").alias("size")).agg(F.count(F.lit(1)).alias("n_rows"))
