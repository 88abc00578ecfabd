"""Fixed schemas of the feed: envelope, record, raw/staging row, silver row, health row."""

from pyspark.sql import types as T

# Message envelope and record layout of the availability feed.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType()),
    T.StructField("request_timestamp", T.StringType()),
    T.StructField("record", T.StringType()),
])

GEO_SCHEMA = T.StructType([
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
])

RECORD_SCHEMA = T.StructType([
    T.StructField("stationcode", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("is_installed", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("numdocksavailable", T.IntegerType()),
    T.StructField("numbikesavailable", T.IntegerType()),
    T.StructField("mechanical", T.IntegerType()),
    T.StructField("ebike", T.IntegerType()),
    T.StructField("is_renting", T.StringType()),
    T.StructField("is_returning", T.StringType()),
    T.StructField("duedate", T.StringType()),
    T.StructField("coordonnees_geo", GEO_SCHEMA),
    T.StructField("nom_arrondissement_communes", T.StringType()),
    T.StructField("code_insee_commune", T.StringType()),
    T.StructField("station_opening_hours", T.StringType()),
])

RECORD_FIELDS = [f.name for f in RECORD_SCHEMA.fields]

# Decoded bronze row: cycle, broker time, dataset, then the 15 record fields.
DECODED_COLUMNS = ["request_timestamp", "kafka_timestamp", "dataset_id"] + RECORD_FIELDS

# Raw JSON-lines / staging row: decoded row plus the batch write time.
RAW_SCHEMA = T.StructType([
    T.StructField("request_timestamp", T.TimestampNTZType()),
    T.StructField("kafka_timestamp", T.TimestampNTZType()),
    T.StructField("dataset_id", T.StringType()),
    *RECORD_SCHEMA.fields,
    T.StructField("insert_timestamp", T.TimestampNTZType()),
])

# Silver change-history row (partitioned by request_date).
SILVER_COLUMNS = [
    "stationcode", "request_timestamp", "name", "is_installed", "capacity",
    "numdocksavailable", "numbikesavailable", "mechanical", "ebike", "is_renting",
    "is_returning", "duedate", "lat", "lon", "nom_arrondissement_communes",
    "code_insee_commune", "station_opening_hours", "kafka_timestamp",
    "insert_timestamp", "silver_updated_at",
]

# The columns queries return of it: without the load time, with the partition date.
SILVER_OUT = [c for c in SILVER_COLUMNS if c != "silver_updated_at"] + ["request_date"]

# Health row (one per component per check).
HEALTH_SCHEMA = T.StructType([
    T.StructField("check_timestamp", T.TimestampNTZType()),
    T.StructField("component", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("lag_seconds", T.DoubleType()),
    T.StructField("lag_messages", T.LongType()),
    T.StructField("details", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("night_mode_active", T.BooleanType()),
])
HEALTH_COLUMNS = [f.name for f in HEALTH_SCHEMA.fields]

# Fixed JSON-lines options of the raw layer: explicit nulls, ISO timestamps with
# microseconds (instants with offset, wall-clock values without).
RAW_JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "encoding": "UTF-8",
}
