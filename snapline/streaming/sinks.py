"""Raw sinks (K1, K2, K3)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from snapline.schemas import RAW_JSON_OPTIONS


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def json_file_sink(writer: DataStreamWriter, path: str) -> DataStreamWriter:
    """K1: append JSON-lines files under ``path`` (commit log in ``_spark_metadata``)."""
    return writer.format("json").options(**RAW_JSON_OPTIONS).option("path", path)


def raw_batch_path(base: str, table: str, insert_ts: datetime, run_id: str, epoch_id: int) -> str:
    """``<base>/<table>/YYYY/MM/DD/<run>-epoch-<n>``: one folder per micro-batch; the
    run id keeps a reset checkpoint (epochs restart at 0) from overwriting older data."""
    return f"{base.rstrip('/')}/{table}/{insert_ts:%Y/%m/%d}/{run_id}-epoch-{epoch_id}"


def raw_sink(base: str, table: str, run_id: str,
             clock: Callable[[], datetime] = utc_now) -> Callable[[DataFrame, int], None]:
    """K2/K3 ``foreachBatch`` writer: stamp ``insert_timestamp`` (one value per batch),
    skip empty batches, write JSON lines from the executors (nothing is collected).
    The batch is persisted so the emptiness probe and the write read the source once;
    a retried epoch overwrites its own folder."""

    def write(df: DataFrame, epoch_id: int) -> None:
        df = df.persist()
        try:
            if df.isEmpty():
                return
            ts = clock()
            (df.withColumn("insert_timestamp", F.lit(ts).cast("timestamp_ntz"))
               .write.mode("overwrite").options(**RAW_JSON_OPTIONS)
               .json(raw_batch_path(base, table, ts, run_id, epoch_id)))
        finally:
            df.unpersist()

    return write


def publish(messages: DataFrame, *, servers: str | None = None, topic: str | None = None,
            path: str | None = None) -> None:
    """Write encoded messages (``value``, and ``key`` if there is one) to a topic, which
    needs the Kafka connector, or as lines of text files under ``path``."""
    if path is not None:
        messages.select("value").write.mode("append").text(path)
        return
    cols = [F.col(c).cast("string") for c in ("key", "value") if c in messages.columns]
    (messages.select(*cols).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
