"""Feed views derived from the driver tables.

``avail`` turns ``events`` into the availability feed: one message per event, the
cycle is the event's hour, the station is the user. Every derived column is a plain
expression of one events row, so the view scales with the table.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapline.functions.casts import to_ntz

# Fixed instant after which stations whose id is a multiple of 7 carry a new name
# (exercises "a rename alone is not a change" and the station dimension).
RENAME_FROM = datetime(2024, 1, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPREAD_BYTES = 4 << 20          # of events that one task widens to feed rows, about
SPREAD_TASKS = 10_000           # beyond, the events are read as the scan splits them


def input_bytes(spark: SparkSession, sf_dir: str, name: str = "events") -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, dealt to tasks by id while their rows are narrow. A feed row is many times as
    wide as its compressed event and costs JSON work, so a scan split by file bytes would give a
    few tasks too much to sort and compute. Small tables stay as they are read."""
    e = table(spark, sf_dir, "events")
    n = -(-input_bytes(spark, sf_dir) // SPREAD_BYTES)
    return e.repartition(n, "event_id") if 1 < n <= SPREAD_TASKS else e


def avail(spark: SparkSession, sf_dir: str, extra: tuple = ()) -> DataFrame:
    """Raw availability messages (decoded form, 18 columns + insert time); ``extra``
    passes events columns through."""
    e = spread_events(spark, sf_dir)
    uid, val = F.col("user_id"), F.col("value")
    bikes = F.floor(val / 50)
    ebikes = F.floor(val / 100)
    k = F.get_json_object("props", "$.k").cast("int")
    renamed = (uid % 7 == 0) & (F.col("ts") >= F.lit(RENAME_FROM).cast("timestamp_ntz"))
    return e.select(
        to_ntz(F.date_trunc("hour", "ts")).alias("request_timestamp"),
        F.col("ts").alias("kafka_timestamp"),
        F.lit("ds").alias("dataset_id"),
        uid.cast("string").alias("stationcode"),
        F.concat(F.lit("st-"), uid.cast("string"), F.when(renamed, F.lit("-b")).otherwise(F.lit(""))).alias("name"),
        F.lit("OUI").alias("is_installed"),
        (F.lit(10) + uid % 50).cast("int").alias("capacity"),
        (F.lit(10) + uid % 50 - bikes).cast("int").alias("numdocksavailable"),
        bikes.cast("int").alias("numbikesavailable"),
        (bikes - ebikes).cast("int").alias("mechanical"),
        ebikes.cast("int").alias("ebike"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(F.lit("OUI")).alias("is_renting"),
        F.lit("NON").alias("is_returning"),
        F.when(k % 10 == 0, F.lit("n/a"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("duedate"),
        F.struct(((F.lit(48000) + uid % 100).cast("double") / F.lit(1000.0)).alias("lat"),
                 ((F.lit(2000) + uid % 100).cast("double") / F.lit(1000.0)).alias("lon")).alias("coordonnees_geo"),
        F.concat(F.lit("arr-"), (uid % 20).cast("string")).alias("nom_arrondissement_communes"),
        (F.lit(75101) + uid % 20).cast("string").alias("code_insee_commune"),
        F.lit("Oui").alias("station_opening_hours"),
        F.col("ts").alias("insert_timestamp"),
        *extra,
    )


def avail_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as broker messages ``(value, timestamp)`` plus the event id."""
    from snapline.operators.envelope import encode_envelope
    a = avail(spark, sf_dir)
    return encode_envelope(a)


# ---------------------------------------------------------------------------------
# Observation tables for the health jobs, derived from ``events``.
# Components are the event types (one producer topic each); the stream is "events"
# with partition = user_id % 3 and hourly micro-batches: at a check time t (an hour
# boundary) the committed offset counts the events before t - 1 h, the high
# watermark those before t.
# ---------------------------------------------------------------------------------

STREAM_PARTITIONS = 3
# Fixed value: the event types, each a topic of its own.
TOPICS = ("click", "error", "purchase", "signup", "view")


def _hour_end(ts: str = "ts"):
    return (to_ntz(F.date_trunc("hour", ts)) + F.expr("INTERVAL 1 HOUR")).alias("check_timestamp")


def producer_heartbeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``check_timestamp, topic, last_ts, high`` per event type and hour with data."""
    from pyspark.sql import Window
    e = table(spark, sf_dir, "events")
    h = e.groupBy(F.col("event_type").alias("topic"), _hour_end()).agg(
        F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("topic").orderBy("check_timestamp").rowsBetween(Window.unboundedPreceding, 0)
    return h.select("check_timestamp", "topic", "last_ts", F.sum("n").over(w).alias("high"))


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``check_timestamp, stream, partition, committed, high, commit_time``."""
    from pyspark.sql import Window
    e = table(spark, sf_dir, "events")
    h = e.groupBy((F.col("user_id") % STREAM_PARTITIONS).cast("int").alias("partition"), _hour_end()).agg(
        F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("partition").orderBy("check_timestamp")
    run = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    x = h.select("check_timestamp", F.lit("events").alias("stream"), "partition",
                 (run - F.col("n")).alias("committed"), run.alias("high"),
                 F.lag("last_ts").over(w).alias("commit_time"))
    committed = x.select("check_timestamp", "stream", "partition", "committed", "commit_time")
    watermarks = x.select("check_timestamp", "stream", "partition", "high")
    from snapline.operators.health import join_offsets
    return join_offsets(committed, watermarks)


def broker_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One broker probe per hour with data: unreachable when the hour saw more than
    three error events; latency = the hour's largest value; controller id
    ``n % 4 - 1`` (so -1, "no controller", in a quarter of the hours)."""
    e = table(spark, sf_dir, "events")
    g = e.groupBy(_hour_end()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("event_type") == "error").cast("int")).alias("n_err"),
        F.max("value").alias("latency_ms"),
        F.countDistinct("event_type").alias("topic_count"),
    )
    return g.select(
        "check_timestamp",
        (F.col("n_err") <= 3).alias("reachable"),
        "latency_ms",
        F.lit(1).alias("broker_count"),
        F.col("topic_count").cast("int").alias("topic_count"),
        (F.col("n") % 4 - 1).cast("int").alias("controller_id"),
        F.when(F.col("n_err") > 3, F.lit("broker not reachable")).alias("error"),
    )


def object_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object names a raw sink would produce for each event, with faults: error
    events land as .txt, every third signup outside the prefix, every fourth purchase
    without its day folder, every ninth view with a non-date folder."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.date_format("ts", "yyyy/MM/dd")
    leaf = F.concat(F.lit("epoch-"), F.col("event_id").cast("string"))
    t = F.col("event_type")
    name = (F.when(t == "error", F.concat(F.lit("avail/"), day, F.lit("/"), leaf, F.lit(".txt")))
             .when((t == "signup") & (k % 3 == 0), F.concat(F.lit("other/"), day, F.lit("/"), leaf, F.lit(".json")))
             .when((t == "purchase") & (k % 4 == 0),
                   F.concat(F.lit("avail/"), F.date_format("ts", "yyyy/MM"), F.lit("/"), leaf, F.lit(".json")))
             .when((t == "view") & (k % 9 == 0), F.concat(F.lit("avail/a/b/c/"), leaf, F.lit(".json")))
             .otherwise(F.concat(F.lit("avail/"), day, F.lit("/"), leaf, F.lit(".json"))))
    return e.select("event_id", name.alias("object_name"))


def landed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as landed broker messages: topic = event type, partition =
    user_id % 3, offset = event id (increasing within each partition)."""
    from snapline.operators.envelope import encode_envelope
    src = avail(spark, sf_dir, extra=("event_id", "event_type", "user_id"))
    m = encode_envelope(src, keep=["event_id", "event_type", "user_id"])
    return m.select(F.col("event_type").alias("topic"),
                    (F.col("user_id") % STREAM_PARTITIONS).cast("int").alias("partition"),
                    F.col("event_id").alias("offset"), "timestamp", "value")


def pages(spark: SparkSession, sf_dir: str, records: DataFrame, page_size: int) -> DataFrame:
    """Page documents ``{"results":[...]}`` of every cycle, as a limit/offset poll returns
    them: ``request_timestamp, page_no, doc``; a cycle whose size is a multiple of the page
    size ends with an empty page. A cycle is one poll: it holds at most one record per
    station, which bounds the window and the page."""
    from pyspark.sql import Window
    from snapline.functions.text import json_text
    w = Window.partitionBy("request_timestamp").orderBy("stationcode")
    x = records.select("request_timestamp", F.struct("stationcode", "capacity", "numbikesavailable").alias("r"),
                       (F.row_number().over(w) - 1).alias("_rn"))
    x = x.withColumn("page_no", F.floor(F.col("_rn") / page_size).cast("int"))
    filled = (x.groupBy("request_timestamp", "page_no")
              .agg(F.sort_array(F.collect_list(F.struct("_rn", "r"))).alias("_rs"))
              .select("request_timestamp", "page_no",
                      json_text(F.struct(F.transform("_rs", lambda e: e["r"]).alias("results"))).alias("doc")))
    full = (x.groupBy("request_timestamp").agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") % page_size == 0)
            .select("request_timestamp", (F.col("_n") / page_size).cast("int").alias("page_no"),
                    F.lit('{"results":[]}').alias("doc")))
    return filled.unionByName(full)
