"""Command-line jobs (for ``spark-submit`` or ``python -m snapline.cli``).

  bronze   feed (Kafka topic or landed-message files) -> decoded raw JSON-lines, one
           dated folder per micro-batch
  silver   raw JSON-lines folder(s) -> change history (C2 as-of, or C1 faithful)
  compact  rewrite closed dates' per-batch folders into one folder per date
  verify   audits over a history: duplicates (must be 0), write avoidance, current state
  health   stream lag/staleness and producer freshness rows at a time, appended to a
           date-partitioned health table

Streams run with a processing-time trigger, or ``--once`` (available-now) for backfills.
"""

from __future__ import annotations

import argparse
import json
from datetime import date


def _session(args):
    from snapline.session import get_session
    return get_session(args.master)


def _trigger(args) -> dict:
    return {"availableNow": True} if args.once else {"processingTime": args.trigger}


def bronze(args) -> None:
    from snapline.operators.envelope import decode_envelope
    from snapline.schemas import RAW_JSON_OPTIONS
    from snapline.sources.feed import kafka_options, open_feed
    from pyspark.sql import functions as F
    from snapline.streaming.jobs import bronze_dedup, start
    from snapline.streaming.sinks import raw_sink
    spark = _session(args)
    if args.source == "kafka":
        feed = open_feed(spark, "kafka", options=kafka_options(
            args.servers, args.topic, starting=args.starting, max_offsets_per_trigger=args.max_per_trigger))
    else:
        feed = open_feed(spark, "files", path=args.path, options=RAW_JSON_OPTIONS,
                         max_per_trigger=args.max_per_trigger)
    rows = decode_envelope(feed)
    if args.dedup:
        rows = bronze_dedup(rows.withColumn("_at", F.col("kafka_timestamp").cast("timestamp")),
                            ["stationcode", "request_timestamp"], "_at", args.dedup).drop("_at")
    name, trigger = f"bronze-{args.table}", _trigger(args)
    if args.sink == "files":
        q = start(rows, "json", args.checkpoint, name=name, trigger=trigger,
                  path=f"{args.raw_base.rstrip('/')}/{args.table}", options=RAW_JSON_OPTIONS)
    else:
        q = start(rows, raw_sink(args.raw_base, args.table, args.run_id), args.checkpoint, name=name,
                  trigger=trigger)
    q.awaitTermination()


def silver(args) -> None:
    from snapline.sources.raw import read_raw
    from snapline.streaming.jobs import start
    from snapline.streaming.metrics import RunMetrics
    from snapline.streaming.silver import silver_sink
    spark = _session(args)
    raw = read_raw(spark, args.raw_glob, streaming=True, max_files_per_trigger=args.max_per_trigger)
    if args.prefix is None:
        raw = raw.drop("source_file")
    lookback = None if args.lookback_days < 0 else args.lookback_days
    metrics = RunMetrics(spark, "silver", args.metrics, args.run_id) if args.metrics else None
    if metrics:
        spark.streams.addListener(metrics)
    q = start(raw, silver_sink(args.history, args.run_id, mode=args.mode, lookback_days=lookback,
                               on_malformed=args.on_malformed, quarantine=args.quarantine, prefix=args.prefix,
                               metrics=metrics, state=args.state),
              args.checkpoint, name="silver", trigger=_trigger(args))
    q.awaitTermination()
    if metrics:
        metrics.wait(q)


def _history(spark, path):
    from snapline.operators.envelope import apply_types
    from snapline.operators.merge import history_schema, read_history
    from snapline.schemas import RAW_SCHEMA
    from snapline.spec import STATION_SPEC
    from pyspark.sql import types as T
    schema = history_schema(apply_types(spark.createDataFrame([], RAW_SCHEMA)).schema, STATION_SPEC)
    schema = T.StructType(schema.fields[:-2] + [T.StructField("silver_updated_at", T.TimestampNTZType())]
                          + schema.fields[-2:])
    return schema, read_history(spark, path, schema, STATION_SPEC)


def compact(args) -> None:
    from snapline.operators.merge import compact_dates
    from snapline.spec import STATION_SPEC
    spark = _session(args)
    schema, _ = _history(spark, args.history)
    dates = [date.fromisoformat(d) for d in args.dates]
    print(json.dumps({"rows": compact_dates(spark, args.history, schema, STATION_SPEC, dates)}))


def verify(args) -> None:
    from snapline.operators import audit, state
    from snapline.spec import STATION_SPEC
    spark = _session(args)
    _, h = _history(spark, args.history)
    dups = audit.duplicates(h, STATION_SPEC.keys + [STATION_SPEC.cycle]).count()
    out = {"duplicates": dups, "history_rows": h.count(),
           "keys": state.current_state(h, STATION_SPEC, cols=list(STATION_SPEC.compared)).count()}
    if args.raw_glob:
        from snapline.operators.dedup import dedup_earliest
        from snapline.operators.envelope import apply_types
        from snapline.sources.raw import read_raw
        d = dedup_earliest(apply_types(read_raw(spark, args.raw_glob)),
                           STATION_SPEC.keys + [STATION_SPEC.cycle], STATION_SPEC.order)
        out.update(audit.write_avoidance(d, h, STATION_SPEC).first().asDict())
    print(json.dumps(out, default=str))


def health(args) -> None:
    from datetime import datetime, timedelta, timezone
    from snapline.operators.health import write_health
    from snapline.plans.monitor import health_check
    from snapline.schemas import RAW_JSON_OPTIONS
    from snapline.sources.feed import kafka_options, open_feed
    spark = _session(args)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    as_of = datetime.fromisoformat(args.as_of) if args.as_of else now
    if args.servers:
        # A tail of the topic: a producer silent for longer is down whatever came before.
        since = as_of.replace(tzinfo=timezone.utc) - timedelta(hours=args.tail_hours)
        options = kafka_options(args.servers, args.topic, starting="earliest")
        options |= {"startingTimestamp": str(int(since.timestamp() * 1000)),
                    "startingOffsetsByTimestampStrategy": "latest"}
        msgs = open_feed(spark, "kafka", streaming=False, options=options)
    else:
        msgs = open_feed(spark, "files", path=args.messages, options=RAW_JSON_OPTIONS, streaming=False)
    probes = None
    if args.probes:
        probes = spark.read.parquet(args.probes)
        probes = probes.filter(probes.check_timestamp <= as_of).orderBy(probes.check_timestamp.desc()).limit(1)
    topics = args.expect or ([args.topic] if args.topic else [])
    rows = health_check(spark, args.checkpoint, msgs, as_of, topics=topics, probes=probes,
                        producer_interval_seconds=args.interval, stream_threshold_seconds=args.threshold)
    write_health(rows, args.health_table, args.check_id or f"{as_of:%Y%m%dT%H%M%S}")
    for r in rows.orderBy("component").collect():  # a handful of rows: one per component
        print(json.dumps(r.asDict(), default=str))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="snapline")
    p.add_argument("--master", default=None, help="only for local runs; spark-submit sets it")
    sub = p.add_subparsers(dest="cmd", required=True)

    b = sub.add_parser("bronze")
    b.add_argument("--source", choices=["kafka", "files"], required=True)
    b.add_argument("--servers"); b.add_argument("--topic"); b.add_argument("--path")
    b.add_argument("--starting", default="latest", choices=["latest", "earliest"])
    b.add_argument("--raw-base", required=True); b.add_argument("--table", default="availability")
    b.add_argument("--checkpoint", required=True); b.add_argument("--run-id", required=True)
    b.add_argument("--max-per-trigger", type=int); b.add_argument("--trigger", default="30 seconds")
    b.add_argument("--once", action="store_true")
    b.add_argument("--sink", choices=["dated", "files"], default="dated",
                   help="a folder per batch, or Spark's file sink with its commit log")
    b.add_argument("--dedup", help="drop copies that arrive within this delay, e.g. '1 hour'")
    b.set_defaults(fn=bronze)

    s = sub.add_parser("silver")
    s.add_argument("--raw-glob", required=True); s.add_argument("--history", required=True)
    s.add_argument("--checkpoint", required=True); s.add_argument("--run-id", required=True)
    s.add_argument("--mode", choices=["asof", "faithful"], default="asof")
    s.add_argument("--lookback-days", type=int, default=7, help="negative: unbounded")
    s.add_argument("--max-per-trigger", type=int); s.add_argument("--trigger", default="30 seconds")
    s.add_argument("--once", action="store_true")
    s.add_argument("--on-malformed", choices=["keep", "drop", "quarantine"], default="keep")
    s.add_argument("--quarantine", help="folder for malformed rows and misplaced files")
    s.add_argument("--metrics", help="folder for one row per micro-batch")
    s.add_argument("--state", help="folder for state snapshots; loads then open the days since the newest one")
    s.add_argument("--prefix", help="load only objects <prefix>YYYY/MM/DD/<file>.json")
    s.set_defaults(fn=silver)

    c = sub.add_parser("compact")
    c.add_argument("--history", required=True); c.add_argument("--dates", nargs="+", required=True)
    c.set_defaults(fn=compact)

    v = sub.add_parser("verify")
    v.add_argument("--history", required=True); v.add_argument("--raw-glob")
    v.set_defaults(fn=verify)

    h = sub.add_parser("health")
    h.add_argument("--checkpoint", required=True, help="checkpoint folder of the Kafka stream")
    h.add_argument("--messages", help="landed messages (instead of --servers/--topic)")
    h.add_argument("--servers"); h.add_argument("--topic")
    h.add_argument("--health-table", required=True); h.add_argument("--as-of")
    h.add_argument("--expect", nargs="*", help="topics that must report")
    h.add_argument("--probes", help="table of broker probe results")
    h.add_argument("--tail-hours", type=float, default=24); h.add_argument("--check-id")
    h.add_argument("--interval", type=int, default=60); h.add_argument("--threshold", type=float, default=120)
    h.set_defaults(fn=health)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
