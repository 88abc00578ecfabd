"""Message envelope: encode (K10) and decode (P1-P5, C4), then typing.

One code path serves batch and streaming DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapline.functions.casts import cycle_date, flag, text_timestamp, to_ntz
from snapline.functions.text import iso_text, json_text
from snapline.schemas import DECODED_COLUMNS, ENVELOPE_SCHEMA, RECORD_FIELDS, RECORD_SCHEMA


def encode_envelope(df: DataFrame, *, dataset_id: str | Column = "dataset_id",
                    cycle: str = "request_timestamp", broker_time: str | None = "kafka_timestamp",
                    record_fields: list[str] = RECORD_FIELDS, keep: list[str] = ()) -> DataFrame:
    """Rows -> ``(value string, timestamp)`` messages.

    ``value`` is the outer JSON object ``{dataset_id, request_timestamp, record}`` in
    which ``record`` is itself JSON *text* of the record fields (double encoding),
    nulls written explicitly, the cycle as ISO-8601 with microseconds.
    """
    ds = F.col(dataset_id) if isinstance(dataset_id, str) else dataset_id
    record = json_text(F.struct(*[F.col(f) for f in record_fields]))
    env = json_text(F.struct(ds.alias("dataset_id"), iso_text(cycle).alias("request_timestamp"),
                             record.alias("record")))
    ts = F.col(broker_time) if broker_time else F.current_timestamp()
    return df.select(*keep, env.alias("value"), to_ntz(ts).alias("timestamp"))


def decode_envelope(df: DataFrame, *, value: str = "value", broker_time: str = "timestamp",
                    keep: list[str] | None = None) -> DataFrame:
    """Messages -> the 18 decoded columns (cycle, broker time, dataset, 15 record fields).

    Malformed input is not dropped: text that is not a JSON object gives an all-NULL
    row, a wrongly typed field is NULL while the others survive (PERMISSIVE).
    ``keep`` passes extra source columns through (e.g. file path, offset).
    """
    env = F.from_json(F.col(value).cast("string"), ENVELOPE_SCHEMA)
    step = df.select(
        *(keep or []),
        to_ntz(F.col(broker_time)).alias("kafka_timestamp"),
        env.alias("_env"),
    )
    rec = F.from_json(F.col("_env.record"), RECORD_SCHEMA)
    out = step.select(
        *(keep or []),
        text_timestamp(F.col("_env.request_timestamp")).alias("request_timestamp"),
        "kafka_timestamp",
        F.col("_env.dataset_id").alias("dataset_id"),
        rec.alias("_r"),
    )
    return out.select(*(keep or []), *[c for c in DECODED_COLUMNS[:3]],
                      *[F.col("_r." + f).alias(f) for f in RECORD_FIELDS])


def is_malformed(fields: list[str] = RECORD_FIELDS) -> Column:
    """True when no record field survived decoding (not JSON, empty, wrong shape)."""
    return ~reduce(lambda a, b: a | b, [F.col(f).isNotNull() for f in fields])


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, quarantined rows)."""
    bad = is_malformed()
    return decoded.filter(~bad), decoded.filter(bad)


def apply_types(df: DataFrame, *, date_col: str = "request_date") -> DataFrame:
    """Raw/staging row -> typed silver row (flags to boolean, due date to timestamp,
    coordinates flattened) plus the partition date."""
    cols = [
        F.col("stationcode"),
        F.col("request_timestamp"),
        F.col("name"),
        flag("is_installed").alias("is_installed"),
        F.col("capacity"), F.col("numdocksavailable"), F.col("numbikesavailable"),
        F.col("mechanical"), F.col("ebike"),
        flag("is_renting").alias("is_renting"),
        flag("is_returning").alias("is_returning"),
        text_timestamp("duedate").alias("duedate"),
        F.col("coordonnees_geo.lat").alias("lat"),
        F.col("coordonnees_geo.lon").alias("lon"),
        F.col("nom_arrondissement_communes"), F.col("code_insee_commune"),
        F.col("station_opening_hours"),
        F.col("kafka_timestamp"),
        (F.col("insert_timestamp") if "insert_timestamp" in df.columns
         else F.lit(None).cast("timestamp_ntz")).alias("insert_timestamp"),
    ]
    return df.select(*cols).withColumn(date_col, cycle_date("request_timestamp"))
