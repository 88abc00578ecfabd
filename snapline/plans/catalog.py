"""Registered queries: name -> f(spark, sf_dir) -> DataFrame.

Each one reads the driver tables (or views derived from them) whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapline.operators.change import changes_sequential
from snapline.operators.dedup import dedup_earliest
from snapline.operators.envelope import apply_types, decode_envelope, encode_envelope, is_malformed
from datetime import date, datetime

from snapline.functions.cadence import Cadence, effective_interval, is_night, local_time
from snapline.operators import audit, health, state
from snapline.operators.cadence import expected_cycles, thin, thin_by_gap
from snapline.operators.change import changes_as_of, changes_vs_state
from snapline.operators.merge import insert_only
from snapline.operators.retention import expired_partitions
from snapline.plans import derived
from snapline.plans.derived import avail, table
from snapline.schemas import RECORD_SCHEMA, SILVER_OUT
from snapline.sources.pages import explode_pages, snapshot_completeness
from snapline.sources.raw import route_objects
from snapline.spec import STATION_SPEC, FeedSpec

# Fixed parameters of the registered queries.
BATCH_DAY = datetime(2024, 1, 20)           # the day loaded as one batch
STATE_AT = datetime(2024, 1, 15, 12, 0)     # "state as of" / incidents instant
COMPARED = list(STATION_SPEC.compared)
PAGE_SIZE = 4                               # small pages so cycles span several
THIN_CADENCE = Cadence(base_seconds=6 * 3600)
FEED_CADENCE = Cadence()
PRODUCER_INTERVAL = 600
STREAM_THRESHOLD = 3600                     # hourly micro-batches in the derived stream

SPEC = STATION_SPEC


def typed(spark: SparkSession, sf: str) -> DataFrame:
    return apply_types(avail(spark, sf))


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_earliest(typed(spark, sf), SPEC.keys + [SPEC.cycle], SPEC.order)


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return changes_sequential(deduped(spark, sf), SPEC)


def q_envelope_roundtrip(spark, sf):
    msgs = encode_envelope(avail(spark, sf))
    d = decode_envelope(msgs)
    return d.select(*[c for c in d.columns if c != "coordonnees_geo"],
                    F.col("coordonnees_geo.lat").alias("lat"), F.col("coordonnees_geo.lon").alias("lon"))


def q_typed_snapshot(spark, sf):
    return typed(spark, sf).select(*SILVER_OUT)


def q_dedup_earliest(spark, sf):
    return deduped(spark, sf).select(*SILVER_OUT)


def q_change_filter_asof(spark, sf):
    return kept(spark, sf).select(*SILVER_OUT)


def q_last_known_state(spark, sf):
    st = state.last_known(kept(spark, sf), SPEC, as_of=BATCH_DAY, before=BATCH_DAY, cols=COMPARED)
    return st.select("stationcode", "request_timestamp", *COMPARED)


def _batch(spark, sf):
    """The batch day's deduplicated rows. The date is a function of the cycle (a dedup
    key), so the filter goes below the dedup and the parquet scan."""
    day = typed(spark, sf).filter(F.col("request_date") == F.lit(BATCH_DAY.date()))
    return dedup_earliest(day, SPEC.keys + [SPEC.cycle], SPEC.order)


def q_change_filter_batch(spark, sf):
    st = state.last_known(kept(spark, sf), SPEC, as_of=BATCH_DAY, before=BATCH_DAY, cols=COMPARED)
    return changes_vs_state(_batch(spark, sf), st, SPEC).select(*SILVER_OUT)


def q_change_filter_step(spark, sf):
    hist = kept(spark, sf).filter(F.col("request_timestamp") < F.lit(BATCH_DAY))
    return changes_as_of(_batch(spark, sf), hist, SPEC).select(*SILVER_OUT)


def q_replay_noop(spark, sf):
    hist = kept(spark, sf)
    b = _batch(spark, sf)
    new = changes_as_of(b, hist, SPEC)
    known = hist.select("stationcode", "request_timestamp", F.lit(1).alias("_known"))
    both = b.select("stationcode", "request_timestamp").join(known, ["stationcode", "request_timestamp"], "left")
    counts = both.agg(F.count(F.lit(1)).alias("n_batch"), F.count("_known").alias("n_already_stored"),
                      F.lit(0).cast("long").alias("n_inserted"))
    zero = F.lit(0).cast("long")
    counts = counts.unionByName(new.agg(F.count(F.lit(1)).alias("n_inserted")).select(
        zero.alias("n_batch"), zero.alias("n_already_stored"), "n_inserted"))
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns])


def q_merge_insert_only(spark, sf):
    k = kept(spark, sf)
    d1, d2 = BATCH_DAY.date(), date(2024, 1, 21)
    target = k.filter(F.col("request_date") <= F.lit(d1))
    source = k.filter(F.col("request_date").between(F.lit(d1), F.lit(d2)))
    return insert_only(source, target, SPEC, dates=[d1, d2]).select(*SILVER_OUT)


def q_merge_bucketed(spark, sf):
    """The history up to a day as a bucketed table, then the next load merged into it, twice."""
    from snapline.operators.bucketed import merge_bucketed, open_bucketed
    from snapline.operators.merge import history_schema
    from snapline.session import checkpoint_dir
    import os
    import uuid
    name = f"history_bucketed_{uuid.uuid4().hex[:12]}"
    k = kept(spark, sf)
    open_bucketed(spark, name, os.path.join(checkpoint_dir(spark), name), history_schema(k.schema, SPEC), SPEC,
                  int(spark.conf.get("spark.sql.shuffle.partitions")))
    d1 = BATCH_DAY.date()
    merge_bucketed(k.filter(F.col("request_date") <= F.lit(d1)), name, SPEC, "load-0")
    batch = k.filter(F.col("request_date") >= F.lit(d1))
    for _ in range(2):                              # the second is a retry and changes nothing
        merge_bucketed(batch, name, SPEC, "load-1")
    return spark.table(name).select(*SILVER_OUT, "batch_id")


def q_current_state(spark, sf):
    return state.current_state(kept(spark, sf), SPEC, cols=["name"] + COMPARED) \
        .select("stationcode", "request_timestamp", "name", *COMPARED)


def q_state_as_of(spark, sf):
    return state.state_as_of(kept(spark, sf), SPEC, STATE_AT, cols=COMPARED) \
        .select("stationcode", "request_timestamp", *COMPARED)


def q_history_intervals(spark, sf):
    return state.intervals(kept(spark, sf), SPEC, cols=COMPARED)


def q_history_reconstruction(spark, sf):
    """Every deduplicated feed row rebuilt from the change history alone."""
    return state.reconstruct(kept(spark, sf), deduped(spark, sf), SPEC).drop("changed_at")


def q_dense_grid(spark, sf):
    """Every station at every cycle of the feed, from the change rows."""
    return state.dense_grid(kept(spark, sf), typed(spark, sf).select(SPEC.cycle), SPEC)


RETENTION_AS_OF = date(2024, 1, 30)
RETENTION_DAYS = 20


def q_history_maintenance(spark, sf):
    """K4/K6 on a stored history: the change rows written as three batches per date,
    every date compacted into one folder (one write), dates past retention dropped,
    the table read back."""
    from snapline.operators.merge import compact_dates, history_schema, partition_dirs, read_history, write_history
    from snapline.operators.retention import drop_expired_paths
    from snapline.session import checkpoint_dir
    import os
    import uuid
    path = os.path.join(checkpoint_dir(spark), f"history-maint-{uuid.uuid4().hex[:12]}")
    k = kept(spark, sf)
    loads = F.concat(F.lit("load-"), (F.hour("request_timestamp") % 3).cast("string"))
    write_history(k, path, SPEC, loads, as_of=datetime(2024, 2, 1))
    schema = history_schema(k.schema, SPEC)
    from pyspark.sql import types as T
    schema = T.StructType(schema.fields[:-2] + [T.StructField("silver_updated_at", T.TimestampNTZType())]
                          + schema.fields[-2:])
    dates = sorted(date.fromisoformat(v) for v, _ in partition_dirs(spark, path, SPEC.date_col) if v)
    compact_dates(spark, path, schema, SPEC, dates)
    drop_expired_paths(spark, path, SPEC.date_col, RETENTION_AS_OF, RETENTION_DAYS)
    return read_history(spark, path, schema, SPEC).select(*SILVER_OUT, "batch_id")


def q_station_dimension(spark, sf):
    return state.dimension(deduped(spark, sf), SPEC)


def q_duplicate_audit(spark, sf):
    return audit.duplicates(typed(spark, sf), ["stationcode", "request_timestamp"])


def q_write_avoidance(spark, sf):
    return audit.write_avoidance(deduped(spark, sf), kept(spark, sf), SPEC)


def q_recent_rows(spark, sf):
    return audit.recent(kept(spark, sf), SPEC, 20,
                        cols=["stationcode", "request_timestamp", "numbikesavailable", "kafka_timestamp"])


def q_rows_per_cycle(spark, sf):
    return audit.rows_per_cycle(avail(spark, sf), SPEC)


def _pages(spark, sf):
    return derived.pages(spark, sf, deduped(spark, sf), PAGE_SIZE)


def q_snapshot_completeness(spark, sf):
    """The second page of cycles polled at 07:00 is lost (a fetch error mid-snapshot)."""
    p = _pages(spark, sf).filter(~((F.hour("request_timestamp") == 7) & (F.col("page_no") == 1)))
    return snapshot_completeness(p, "request_timestamp", PAGE_SIZE)


def q_paged_records(spark, sf):
    rec = explode_pages(_pages(spark, sf), RECORD_SCHEMA, keep=["request_timestamp", "page_no"])
    return rec.select("request_timestamp", "page_no", "stationcode", "capacity", "numbikesavailable")


def q_path_routing(spark, sf):
    return route_objects(derived.object_names(spark, sf), "object_name", "avail/") \
        .select("object_name", "route", "batch_date")


def q_night_flag(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "ts", local_time("ts", FEED_CADENCE.tz).alias("local_ts"),
                    is_night("ts", FEED_CADENCE).alias("is_night"))


def q_effective_interval(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", effective_interval("ts", FEED_CADENCE).alias("interval_seconds"))


def q_cadence_thin(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    return thin(e, ["user_id"], "ts", THIN_CADENCE)


def q_cadence_gap(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    return thin_by_gap(e, ["user_id"], "ts", THIN_CADENCE)


def q_expected_cycles(spark, sf):
    days = table(spark, sf, "events").select(F.to_date("ts").alias("day")).distinct()
    return expected_cycles(days, "day", FEED_CADENCE)


def q_freshness_status(spark, sf):
    return health.producer_health(derived.producer_heartbeats(spark, sf), PRODUCER_INTERVAL, FEED_CADENCE)


def q_partition_lag(spark, sf):
    return health.partition_lag(derived.stream_offsets(spark, sf)).drop("commit_time")


def q_stream_lag(spark, sf):
    return health.stream_health(derived.stream_offsets(spark, sf), STREAM_THRESHOLD, FEED_CADENCE,
                                component_prefix="pyspark_")


def q_controller_status(spark, sf):
    k = health.broker_rows(derived.broker_probes(spark, sf), FEED_CADENCE)
    return k.drop("controller_id").unionByName(health.controller_rows(k))


def health_table(spark, sf):
    """All health rows of the derived pipeline (O3: stacked components)."""
    k = health.broker_rows(derived.broker_probes(spark, sf), FEED_CADENCE)
    return (k.drop("controller_id")
            .unionByName(health.controller_rows(k))
            .unionByName(q_stream_lag(spark, sf))
            .unionByName(q_freshness_status(spark, sf)))


def q_status_board(spark, sf):
    return health.status_board(health_table(spark, sf))


def q_incidents_24h(spark, sf):
    return health.incidents(health_table(spark, sf), STATE_AT, 24)


def q_health_outage(spark, sf):
    """Job-level check of a stream that never committed and of topics nobody wrote to: the
    landed messages up to the instant, no checkpoint folder, one topic too many expected."""
    import os
    import uuid
    from snapline.plans.monitor import health_check
    from snapline.session import checkpoint_dir
    none = os.path.join(checkpoint_dir(spark), f"never-started-{uuid.uuid4().hex[:12]}")
    return health_check(spark, none, derived.landed_messages(spark, sf), STATE_AT,
                        topics=[*derived.TOPICS, "never-written"],
                        producer_interval_seconds=PRODUCER_INTERVAL)


def q_retention_candidates(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("order_date"))
    return expired_partitions(o, "order_date", date(1998, 8, 2), 365)


ORDERS_SPEC = FeedSpec(key=("o_custkey",), cycle="o_orderdate", order=("o_orderkey",),
                       compared=("o_orderstatus", "o_orderpriority"), date_col="order_date",
                       lookback_days=None, buckets=(365 * 86400,))
LINEITEM_SPEC = FeedSpec(key=("l_partkey",), cycle="l_shipdate",
                         order=("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
                                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"),
                         compared=("l_returnflag", "l_linestatus"), date_col="ship_date",
                         lookback_days=None, buckets=(365 * 86400,))


def change_history(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """Earliest copy per (key, cycle), then the sequential change filter."""
    d = dedup_earliest(df, spec.keys + [spec.cycle], spec.order)
    return changes_sequential(d, spec)


def q_orders_change_history(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus",
                                          "o_orderpriority", "o_totalprice")
    return change_history(o, ORDERS_SPEC)


def q_lineitem_change_history(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_shipdate", *LINEITEM_SPEC.order)
    return change_history(li, LINEITEM_SPEC)


def q_decode_malformed(spark, sf):
    """Broker messages where error events carry damaged payloads (by ``k % 5``:
    not JSON, a JSON array, an empty object, wrongly typed fields with a bad
    timestamp, no value); every message still yields one decoded row."""
    src = avail(spark, sf, extra=("event_id", "event_type",
                                  F.get_json_object("props", "$.k").cast("int").alias("k")))
    m = encode_envelope(src, keep=["event_id", "event_type", "k"])
    bad_typed = ('{"dataset_id":"ds","request_timestamp":"bad","record":'
                 '"{\\"stationcode\\":12,\\"capacity\\":\\"5\\",\\"numbikesavailable\\":5.0,'
                 '\\"ebike\\":99999999999,\\"z\\":7}"}')
    k5 = F.col("k") % 5
    value = (F.when(F.col("event_type") != "error", F.col("value"))
              .when(k5 == 0, F.lit("not json"))
              .when(k5 == 1, F.lit("[]"))
              .when(k5 == 2, F.lit("{}"))
              .when(k5 == 3, F.lit(bad_typed))
              .otherwise(F.lit(None).cast("string")))
    d = decode_envelope(m.select("event_id", value.alias("value"), "timestamp"), keep=["event_id"])
    return d.select("event_id", "kafka_timestamp", "request_timestamp", "dataset_id", "stationcode",
                    "capacity", "numbikesavailable", "ebike", "is_renting",
                    is_malformed().alias("malformed"))


# A feed where one key holds a third of all rows: users whose id is a multiple of 3
# report as station -1; the cycle is the event time itself.
HOT_SPEC = FeedSpec(key=("station",), cycle="ts", order=("event_id",), compared=("event_type",),
                    date_col="day", lookback_days=None,
                    buckets=(3600, 86400, 30 * 86400))


def hot_feed(spark, sf):
    e = table(spark, sf, "events")
    station = F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    return e.select(station.alias("station"), "ts", "event_id", "event_type", "value")


def q_hot_key_change_history(spark, sf):
    return change_history(hot_feed(spark, sf), HOT_SPEC)


def q_topic_watermarks(spark, sf):
    from snapline.sources.feed import topic_watermarks
    return topic_watermarks(derived.landed_messages(spark, sf))


def q_broker_summary(spark, sf):
    from snapline.sources.feed import broker_summary
    return broker_summary(q_topic_watermarks(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_roundtrip": q_envelope_roundtrip,
    "typed_snapshot": q_typed_snapshot,
    "dedup_earliest": q_dedup_earliest,
    "change_filter_asof": q_change_filter_asof,
    "last_known_state": q_last_known_state,
    "change_filter_batch": q_change_filter_batch,
    "change_filter_step": q_change_filter_step,
    "replay_noop": q_replay_noop,
    "merge_insert_only": q_merge_insert_only,
    "merge_bucketed": q_merge_bucketed,
    "current_state": q_current_state,
    "state_as_of": q_state_as_of,
    "history_intervals": q_history_intervals,
    "history_reconstruction": q_history_reconstruction,
    "dense_grid": q_dense_grid,
    "station_dimension": q_station_dimension,
    "history_maintenance": q_history_maintenance,
    "duplicate_audit": q_duplicate_audit,
    "write_avoidance": q_write_avoidance,
    "recent_rows": q_recent_rows,
    "rows_per_cycle": q_rows_per_cycle,
    "snapshot_completeness": q_snapshot_completeness,
    "paged_records": q_paged_records,
    "path_routing": q_path_routing,
    "night_flag": q_night_flag,
    "effective_interval": q_effective_interval,
    "cadence_thin": q_cadence_thin,
    "cadence_gap": q_cadence_gap,
    "expected_cycles": q_expected_cycles,
    "freshness_status": q_freshness_status,
    "partition_lag": q_partition_lag,
    "stream_lag": q_stream_lag,
    "controller_status": q_controller_status,
    "status_board": q_status_board,
    "incidents_24h": q_incidents_24h,
    "health_outage": q_health_outage,
    "retention_candidates": q_retention_candidates,
    "orders_change_history": q_orders_change_history,
    "lineitem_change_history": q_lineitem_change_history,
    "decode_malformed": q_decode_malformed,
    "topic_watermarks": q_topic_watermarks,
    "broker_summary": q_broker_summary,
    "hot_key_change_history": q_hot_key_change_history,
}


def _with_streams():
    from snapline.plans.streams import STREAM_QUERIES
    QUERIES.update(STREAM_QUERIES)


_with_streams()
