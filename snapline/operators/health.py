"""Pipeline health as table jobs.

Inputs are observation tables (heartbeats, offsets, probe results); outputs are health
rows ``check_timestamp, component, status, latency_ms, lag_seconds, lag_messages,
details, error_message, night_mode_active``.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from snapline.functions.cadence import Cadence, is_night
from snapline.functions.status import (DOWN, HEALTHY, age_seconds, clamp_lag, round_tenth,
                                       status_of)
from snapline.functions.text import json_text
from snapline.operators.state import latest_per_key
from snapline.schemas import HEALTH_COLUMNS

# Defaults of the checks (stream staleness 120 s; producer tolerance is
# twice the expected interval) and component naming.
STREAM_THRESHOLD_SECONDS = 120
PRODUCER_TOLERANCE_FACTOR = 2
KRAFT_COMPONENT = "kraft_controller"
KAFKA_COMPONENT = "kafka"

NO_MESSAGE = "topic is silent: nothing to read"
NO_CHECKPOINT = "stream has committed nothing so far"
NO_CONTROLLER = "cluster reports no controller id"


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def health_rows(df: DataFrame, cadence: Cadence | None = Cadence(), keep: tuple = ()) -> DataFrame:
    """Complete a partial health frame to the standard column set and order
    (``keep`` names extra columns carried along at the end)."""
    cols = {c: df[c] for c in df.columns}
    types = {"latency_ms": "double", "lag_seconds": "double", "lag_messages": "bigint",
             "details": "string", "error_message": "string"}
    out = []
    for c in HEALTH_COLUMNS:
        if c in cols:
            out.append(cols[c].cast(types[c]).alias(c) if c in types else cols[c])
        elif c == "details":
            out.append(F.lit("{}").alias(c))
        elif c == "night_mode_active":
            out.append((is_night("check_timestamp", cadence) if cadence else F.lit(False)).alias(c))
        else:
            out.append(_null(types.get(c, "string")).alias(c))
    return df.select(*out, *keep)


def producer_health(last_msgs: DataFrame, interval_seconds: int, cadence: Cadence = Cadence(),
                    component_prefix: str = "producer_") -> DataFrame:
    """M3: freshness of each topic's newest message at each check.

    ``last_msgs``: ``check_timestamp, topic, last_ts, high``. Tolerance is
    ``interval x (multiplier at night) x 2``; no message -> down.
    """
    night = is_night("check_timestamp", cadence)
    mult = F.when(night, F.lit(cadence.multiplier)).otherwise(F.lit(1.0))
    tol = F.lit(float(interval_seconds)) * mult * F.lit(PRODUCER_TOLERANCE_FACTOR)
    age = age_seconds("check_timestamp", "last_ts")
    none = F.col("last_ts").isNull()
    return health_rows(last_msgs.select(
        "check_timestamp",
        F.concat(F.lit(component_prefix), F.col("topic")).alias("component"),
        F.when(none, F.lit(DOWN)).otherwise(status_of(age, tol)).alias("status"),
        round_tenth(age).alias("lag_seconds"),
        F.when(none, F.lit("{}")).otherwise(json_text(F.struct(F.col("high").alias("latest_offset")))).alias("details"),
        F.when(none, F.lit(NO_MESSAGE)).alias("error_message"),
        night.alias("night_mode_active"),
    ), cadence)


def join_offsets(committed: DataFrame, watermarks: DataFrame,
                 on: tuple = ("check_timestamp", "stream", "partition")) -> DataFrame:
    """Committed offsets (from the checkpoint) left-joined to the broker's high
    watermarks by (check, stream, partition); ``high`` is NULL where unknown."""
    return committed.join(watermarks.select(*on, "high"), list(on), "left")


def partition_lag(offsets: DataFrame) -> DataFrame:
    """Lag per (check, stream, partition) = clamp(high - committed), NULL when
    the high watermark is unknown. ``offsets``: ``check_timestamp, stream, partition,
    committed, high``; other columns stay."""
    return offsets.withColumn("lag_messages", clamp_lag("high", "committed"))


def with_expected(rows: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """M2/M3: one row at least for every (check, component) that should report: what
    ``rows`` does not hold comes with NULL measures, which the checks report as down.
    ``expected`` holds the columns ``on``."""
    return expected.select(*on).distinct().join(rows, on, "left")


def stream_health(offsets: DataFrame, threshold_seconds: float = STREAM_THRESHOLD_SECONDS,
                  cadence: Cadence = Cadence(), component_prefix: str = "pyspark_") -> DataFrame:
    """M2: one row per (check, stream) over all its partitions.

    ``lag_seconds`` = check time - newest commit; ``lag_messages`` = sum of clamped
    partition lags (NULL if any high watermark is unknown); nothing committed -> down.
    """
    g = partition_lag(offsets).groupBy("check_timestamp", "stream").agg(
        F.max("commit_time").alias("commit_time"),
        F.sum("committed").alias("committed"),
        F.sum("high").alias("high"),
        F.sum("lag_messages").alias("lag_messages"),
        F.max(F.col("high").isNull().cast("int")).alias("_unknown"),
    )
    age = age_seconds("check_timestamp", "commit_time")
    none = F.col("commit_time").isNull()
    return health_rows(g.select(
        "check_timestamp",
        F.concat(F.lit(component_prefix), F.col("stream")).alias("component"),
        F.when(none, F.lit(DOWN)).otherwise(status_of(age, float(threshold_seconds))).alias("status"),
        round_tenth(age).alias("lag_seconds"),
        F.when((F.col("_unknown") == 0) & ~none, F.col("lag_messages")).alias("lag_messages"),
        F.when(none, F.lit("{}")).otherwise(json_text(F.struct(
            F.col("committed").alias("committed_offset"),
            F.col("high").alias("kafka_high_watermark")))).alias("details"),
        F.when(none, F.lit(NO_CHECKPOINT)).alias("error_message"),
    ), cadence)


def broker_rows(probes: DataFrame, cadence: Cadence = Cadence()) -> DataFrame:
    """M4: broker probe results -> kafka rows (plus ``controller_id`` for J4).

    ``probes``: ``check_timestamp, reachable, latency_ms, broker_count, topic_count,
    controller_id, error``."""
    ok = F.col("reachable")
    rows = health_rows(probes.select(
        "check_timestamp",
        F.lit(KAFKA_COMPONENT).alias("component"),
        F.when(ok, F.lit(HEALTHY)).otherwise(F.lit(DOWN)).alias("status"),
        F.when(ok, F.col("latency_ms")).alias("latency_ms"),
        F.when(ok, json_text(F.struct("broker_count", "topic_count", "controller_id")))
         .otherwise(F.lit("{}")).alias("details"),
        F.when(~ok, F.col("error")).alias("error_message"),
        F.when(ok, F.col("controller_id")).alias("controller_id"),
    ), cadence, keep=("controller_id",))
    return rows


def controller_rows(kafka: DataFrame) -> DataFrame:
    """Derive the controller row from the kafka row (no second probe): same
    measures, other component; a healthy kafka row without a controller (id < 0 or
    missing) becomes down. A down kafka row is inherited as is."""
    no_ctrl = F.coalesce(F.col("controller_id"), F.lit(-1)) < 0
    flip = (F.col("status") == HEALTHY) & no_ctrl
    return kafka.select(
        "check_timestamp",
        F.lit(KRAFT_COMPONENT).alias("component"),
        F.when(flip, F.lit(DOWN)).otherwise(F.col("status")).alias("status"),
        "latency_ms", "lag_seconds", "lag_messages", "details",
        F.when(flip, F.lit(NO_CONTROLLER)).otherwise(F.col("error_message")).alias("error_message"),
        "night_mode_active",
    )


def status_board(health: DataFrame) -> DataFrame:
    """Latest row per component, ordered by component."""
    cols = [c for c in HEALTH_COLUMNS if c not in ("component", "check_timestamp")]
    return latest_per_key(health, ["component"], "check_timestamp", cols) \
        .select(*HEALTH_COLUMNS).orderBy("component")


def incidents(health: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    """M7: non-healthy rows in the ``hours`` before ``as_of``, newest first."""
    since = as_of - timedelta(hours=hours)
    return (health.filter((F.col("status") != HEALTHY)
                          & (F.col("check_timestamp") >= F.lit(since))
                          & (F.col("check_timestamp") <= F.lit(as_of)))
                  .select("check_timestamp", "component", "status", "error_message")
                  .orderBy(F.col("check_timestamp").desc(), F.col("component")))


def write_health(health: DataFrame, path: str, check_id: str) -> None:
    """K5/K9: health rows partitioned by check date and check id, clustered by (component,
    status) inside files. A repeated check replaces its own rows."""
    (health.withColumns({"check_date": F.to_date("check_timestamp"), "check_id": F.lit(check_id)})
           .repartition("check_date").sortWithinPartitions("component", "status")
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("check_date", "check_id").parquet(path))
