"""Streaming queries over the derived feed.

The feed is landed as raw JSON-lines, one folder per day (what the raw sink writes),
and read back as a file stream, a day or a week per micro-batch. The stream's final table is
compared with the batch queries' oracle.
"""

from __future__ import annotations

import os
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapline.operators.dedup import dedup_earliest
from snapline.operators.distinct import day_bitmaps, distinct_counts, number_keys
from snapline.operators.envelope import apply_types, decode_envelope, encode_envelope
from snapline.operators.merge import history_schema, partition_dirs, read_history
from snapline.plans.derived import avail, input_bytes
from snapline.schemas import RAW_JSON_OPTIONS, RAW_SCHEMA, SILVER_OUT
from snapline.session import checkpoint_dir
from snapline.sources.logs import checkpoint_offsets, committed_files
from snapline.sources.raw import read_raw
from snapline.spec import STATION_SPEC
from snapline.streaming.jobs import run_available
from snapline.streaming.metrics import RunMetrics, read_metrics
from snapline.streaming.repair import load_with_repair
from snapline.streaming.silver import load_batch, silver_sink
from snapline.sources.feed import open_feed
from snapline.plans.derived import landed_messages
from snapline.streaming.sinks import json_file_sink, raw_sink
from snapline.streaming.stateful import stateful_changes



def _scratch(spark: SparkSession, tag: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex[:12]}")


FILE_BYTES = 128 << 20                  # of input a landed file holds at most, about
GROUP_BYTES = 64 << 10                  # of input whose keys share a row of the state store, about
LOOKBACK_DAYS = 7                       # of the stream with the reference's look-back


def land_days(df: DataFrame, day: Column, spread: str, base: str, files_per_day: int,
              since: date | None = None, until: date | None = None) -> list[str]:
    """Write ``df`` as JSON-lines in one job: a folder per day under ``base``, each day's rows
    spread over ``files_per_day`` tasks by ``spread`` (a key's day stays in one file). A file
    stream takes files by age, so each day's files then get the day as their time: one metadata
    call a file. Days outside [since, until) are left out. Returns the folders, oldest first."""
    spark = df.sparkSession
    x = df.withColumns({"_day": day, "_part": F.pmod(F.xxhash64(spread), F.lit(files_per_day))})
    if since is not None:
        x = x.filter(F.col("_day") >= F.lit(since))
    if until is not None:
        x = x.filter(F.col("_day") < F.lit(until))
    (x.withColumn("day", F.date_format("_day", "yyyy-MM-dd"))
      .repartition("_day", "_part").drop("_day", "_part")
      .write.mode("append").partitionBy("day").options(**RAW_JSON_OPTIONS).json(base))
    out = []
    for value, folder in partition_dirs(spark, base, "day"):
        at = date.fromisoformat(value)
        if (since is None or at >= since) and (until is None or at < until):
            ms = int(datetime(at.year, at.month, at.day, tzinfo=timezone.utc).timestamp() * 1000)
            p = spark._jvm.org.apache.hadoop.fs.Path(folder)
            fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
            for st in fs.listStatus(p):
                fs.setTimes(st.getPath(), ms, -1)
            out.append(folder)
    return sorted(out)


def files_per_day(spark: SparkSession, sf: str) -> int:
    """By the input's size, as if all of it fell on one day of a month."""
    return max(1, -(-input_bytes(spark, sf) // (30 * FILE_BYTES)))


def land_raw_days(spark: SparkSession, sf: str, base: str, since: date | None = None,
                  until: date | None = None) -> list[str]:
    """The feed as raw JSON-lines, one folder per request day."""
    return land_days(avail(spark, sf), F.to_date("request_timestamp"), "stationcode", base,
                     files_per_day(spark, sf), since, until)


def raw_stream(spark: SparkSession, base: str, files_per_batch: int | None = 1) -> DataFrame:
    r = spark.readStream.schema(RAW_SCHEMA).options(**RAW_JSON_OPTIONS)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    return r.json(f"{base}/*")


def _silver(spark, path) -> DataFrame:
    schema = history_schema(apply_types(spark.createDataFrame([], RAW_SCHEMA)).schema, STATION_SPEC)
    return read_history(spark, path, schema, STATION_SPEC)


def q_stream_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files -> foreachBatch silver load (C2 with the 7-day look-back): a batch
    opens the date folders of its look-back, however long the history is. A backlog is
    taken a week of files at a time; the rows do not depend on that."""
    root = _scratch(spark, "stream-silver")
    land_raw_days(spark, sf, f"{root}/raw")
    run_available(raw_stream(spark, f"{root}/raw", 7 * files_per_day(spark, sf)),
                  silver_sink(f"{root}/silver", "run1", lookback_days=LOOKBACK_DAYS), f"{root}/ck")
    return _silver(spark, f"{root}/silver").select(*SILVER_OUT)


def q_run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """The silver stream with a listener that writes a row per micro-batch; totals of
    that table, and the batches whose inserted rows differ from the rows stored under their id."""
    root = _scratch(spark, "run-metrics")
    land_raw_days(spark, sf, f"{root}/raw")
    listener = RunMetrics(spark, "run-metrics", f"{root}/metrics", "run1")
    spark.streams.addListener(listener)
    try:
        q = run_available(raw_stream(spark, f"{root}/raw", 7 * files_per_day(spark, sf)),
                          silver_sink(f"{root}/silver", "run1", lookback_days=None, metrics=listener), f"{root}/ck",
                          name="run-metrics")
        listener.wait(q)
    finally:
        spark.streams.removeListener(listener)
    told = read_metrics(spark, f"{root}/metrics").withColumn("id", F.format_string("%s-%06d", "run_id", "batch_id"))
    held = _silver(spark, f"{root}/silver").groupBy(F.col("batch_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return told.join(held, "id", "full").agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"),
        F.count_if(F.coalesce("inserted", F.lit(0)) != F.coalesce("n", F.lit(0))).alias("batches_that_differ"))


RANGE_DAYS = 7


def q_distinct_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """A1/A2/A5: cycles, keys and rows of every range of seven days that ends on a day of the feed,
    from a stored table of day bitmaps; the feed is read once, however many ranges are asked."""
    root = _scratch(spark, "distinct-days")
    spec = STATION_SPEC
    rows = dedup_earliest(apply_types(avail(spark, sf)), spec.keys + [spec.cycle], spec.order)
    number_keys(rows, spec).write.parquet(f"{root}/ids")
    day_bitmaps(rows, spark.read.parquet(f"{root}/ids"), spec).write.parquet(f"{root}/days")
    days = spark.read.parquet(f"{root}/days")
    ends = days.select(F.col(spec.date_col).alias("end_date")).dropna().distinct()
    reach = days.dropna(subset=[spec.date_col]).withColumn("end_date", F.explode(F.sequence(
        F.col(spec.date_col), F.date_add(spec.date_col, RANGE_DAYS - 1))))
    return distinct_counts(reach.join(ends, "end_date"), ["end_date"])


SNAPSHOT_BATCH_DAYS = 5


def q_silver_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """W2/J1 with state snapshots: the whole feed, some days a load. A load opens the newest
    snapshot and the days since it, not the look-back. Same rows as ``stream_silver``."""
    root = _scratch(spark, "silver-snapshots")
    feed = avail(spark, sf)
    cycle = F.col("request_timestamp")
    span = feed.agg(F.min(cycle).alias("lo"), F.max(cycle).alias("hi")).first()
    at, i = span["lo"] and datetime(span["lo"].year, span["lo"].month, span["lo"].day), 0
    while at is not None and at <= span["hi"]:
        end = at + timedelta(days=SNAPSHOT_BATCH_DAYS)
        load_batch(feed.filter((cycle >= F.lit(at)) & (cycle < F.lit(end))), f"{root}/silver", f"b{i:03d}",
                   lookback_days=LOOKBACK_DAYS, state=f"{root}/state")
        at, i = end, i + 1
    load_batch(feed.filter(cycle.isNull()), f"{root}/silver", "undated", lookback_days=LOOKBACK_DAYS)
    return _silver(spark, f"{root}/silver").select(*SILVER_OUT)


LATE_BATCHES = 3


def q_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The whole feed in batches that a hash of the row deals out, so that most rows come
    late; each load repairs what it touches. The history equals that of the feed in order."""
    root = _scratch(spark, "late-rows")
    feed = avail(spark, sf).withColumn("_in", F.pmod(F.xxhash64("stationcode", "kafka_timestamp"), F.lit(LATE_BATCHES)))
    for i in range(LATE_BATCHES):
        load_with_repair(feed.filter(F.col("_in") == i).drop("_in"), f"{root}/silver", f"{root}/landed", f"b{i}",
                         lookback_days=LOOKBACK_DAYS)
    return _silver(spark, f"{root}/silver").select(*SILVER_OUT)


def q_silver_faithful(spark: SparkSession, sf: str) -> DataFrame:
    """C1 load of the whole feed in three batches: everything before a day, the day against the
    state stored, and everything after it against the state stored then."""
    root = _scratch(spark, "silver-faithful")
    day = datetime(2024, 1, 20)
    feed = avail(spark, sf)
    cycle = F.col("request_timestamp")
    for i, part in enumerate((feed.filter(cycle < F.lit(day)),
                              feed.filter((cycle >= F.lit(day)) & (cycle < F.lit(day + timedelta(days=1)))),
                              feed.filter(cycle >= F.lit(day + timedelta(days=1))))):
        load_batch(part, f"{root}/silver", f"b{i}", mode="faithful", lookback_days=LOOKBACK_DAYS)
    return _silver(spark, f"{root}/silver").select(*SILVER_OUT)


def q_silver_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """C3/S5 with damaged messages: error events decode to rows without any field. The whole feed
    is loaded ten days at a time; one load keeps them (they are stored without a date), the next
    sends them to quarantine, the next drops them, and so on."""
    root = _scratch(spark, "silver-malformed")
    src = avail(spark, sf, extra=("event_type",))
    m = encode_envelope(src, keep=["event_type"])
    bad = F.when(F.col("event_type") == "error", F.lit("not json")).otherwise(F.col("value"))
    d = decode_envelope(m.withColumn("value", bad)).withColumn("insert_timestamp", F.lit(None).cast("timestamp_ntz"))
    span = src.agg(F.min("kafka_timestamp").alias("lo"), F.max("kafka_timestamp").alias("hi")).first()
    lo, i = datetime(span["lo"].year, span["lo"].month, span["lo"].day), 0
    while lo <= span["hi"]:
        end = lo + timedelta(days=10)
        part = d.filter((F.col("kafka_timestamp") >= F.lit(lo)) & (F.col("kafka_timestamp") < F.lit(end)))
        load_batch(part, f"{root}/silver", f"b{i:03d}", lookback_days=LOOKBACK_DAYS,
                   on_malformed=("keep", "quarantine", "drop")[i % 3], quarantine=f"{root}/quarantine")
        lo, i = end, i + 1
    stored = _silver(spark, f"{root}/silver").select("stationcode", "request_timestamp", "kafka_timestamp",
                                                     "request_date", F.lit("stored").alias("place"))
    q = spark.read.schema(RAW_SCHEMA).options(**RAW_JSON_OPTIONS).json(f"{root}/quarantine")
    return stored.unionByName(q.select("stationcode", "request_timestamp", "kafka_timestamp",
                                       F.lit(None).cast("date").alias("request_date"),
                                       F.lit("quarantine").alias("place")))


def q_stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Stop after half the days, land the rest, resume on the same checkpoint;
    then lose the checkpoint and replay everything under a new run id, a week of files a
    batch. The history equals one uninterrupted run."""
    root = _scratch(spark, "stream-resume")
    n = files_per_day(spark, sf)
    half = date(2024, 1, 16)
    sink = silver_sink(f"{root}/silver", "run1", lookback_days=None)
    land_raw_days(spark, sf, f"{root}/raw", until=half)
    run_available(raw_stream(spark, f"{root}/raw", 7 * n), sink, f"{root}/ck1")
    land_raw_days(spark, sf, f"{root}/raw", since=half)
    run_available(raw_stream(spark, f"{root}/raw", 7 * n), sink, f"{root}/ck1")
    run_available(raw_stream(spark, f"{root}/raw", 7 * n),
                  silver_sink(f"{root}/silver", "run2", lookback_days=None), f"{root}/ck2")
    return _silver(spark, f"{root}/silver").select(*SILVER_OUT)


def q_stream_stateful(spark: SparkSession, sf: str) -> DataFrame:
    """Typed file stream -> per-key state -> parquet file sink."""
    root = _scratch(spark, "stream-stateful")
    land_raw_days(spark, sf, f"{root}/raw")
    typed = apply_types(raw_stream(spark, f"{root}/raw", 7 * files_per_day(spark, sf)))
    kept = stateful_changes(typed, STATION_SPEC, lookback_days=None,
                            groups=max(64, input_bytes(spark, sf) // GROUP_BYTES))
    run_available(kept, "parquet", f"{root}/ck", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out").select(*SILVER_OUT)


def _json_stream(df: DataFrame, checkpoint: str, out: str) -> None:
    """K1: the file-sink variant of the raw layer (JSON lines + commit log), run to the end."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    q = json_file_sink(w, out).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def q_checkpoint_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets log of a raw-to-JSON stream (K1 file sink) over the feed, a day a batch."""
    root = _scratch(spark, "stream-logs")
    land_raw_days(spark, sf, f"{root}/raw")
    _json_stream(raw_stream(spark, f"{root}/raw", files_per_day(spark, sf)), f"{root}/ck", f"{root}/out")
    return checkpoint_offsets(spark, f"{root}/ck").select("batch_id", "source_index", "log_offset")


def q_sink_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """What the same JSON file sink committed: files and rows, as its readers see them."""
    root = _scratch(spark, "stream-sink")
    land_raw_days(spark, sf, f"{root}/raw")
    _json_stream(raw_stream(spark, f"{root}/raw", files_per_day(spark, sf)), f"{root}/ck", f"{root}/out")
    m = committed_files(spark, f"{root}/out", RAW_SCHEMA, **RAW_JSON_OPTIONS)
    return m.agg(F.count(F.lit(1)).alias("n_files"), F.sum("n_rows").alias("n_rows"))


LANDING_CLOCK = datetime(2024, 2, 1)


def q_raw_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Landed broker messages (one folder per day) -> file feed
    stream -> decode -> raw JSON-lines sink (fixed batch clock) -> batch read of the
    raw layer with its explicit schema."""
    root = _scratch(spark, "raw-landing")
    n = files_per_day(spark, sf)
    land_days(landed_messages(spark, sf), F.to_date("timestamp"), "offset", f"{root}/msgs", n)
    feed = open_feed(spark, "files", path=f"{root}/msgs/*", options=RAW_JSON_OPTIONS, max_per_trigger=7 * n)
    run_available(decode_envelope(feed), raw_sink(f"{root}/raw", "avail", "run1", clock=lambda: LANDING_CLOCK),
                  f"{root}/ck")
    raw = read_raw(spark, f"{root}/raw/avail/*/*/*/*")
    return raw.select(*[c for c in raw.columns if c != "coordonnees_geo"],
                      F.col("coordonnees_geo.lat").alias("lat"), F.col("coordonnees_geo.lon").alias("lon"))


STREAM_QUERIES = {
    "raw_landing": q_raw_landing,
    "stream_silver": q_stream_silver,
    "silver_snapshots": q_silver_snapshots,
    "run_metrics": q_run_metrics,
    "distinct_by_range": q_distinct_by_range,
    "late_rows": q_late_rows,
    "silver_faithful": q_silver_faithful,
    "silver_malformed": q_silver_malformed,
    "stream_resume": q_stream_resume,
    "stream_stateful": q_stream_stateful,
    "checkpoint_offsets": q_checkpoint_offsets,
    "sink_manifest": q_sink_manifest,
}
