"""Raw JSON-lines files (S3, S4) and object-name routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapline.functions.text import path_parts
from snapline.schemas import RAW_JSON_OPTIONS, RAW_SCHEMA

ACCEPTED, IGNORED, QUARANTINED = "accepted", "ignored", "quarantined"


def read_raw(spark: SparkSession, path: str, *, streaming: bool = False, mode: str = "FAILFAST",
             max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw JSON-lines with the explicit 19-column schema, never inferred. Batch reads
    fail on a bad line (like a warehouse load job); streams carry the file path."""
    if streaming:
        r = spark.readStream.schema(RAW_SCHEMA).options(**RAW_JSON_OPTIONS).option("mode", "PERMISSIVE")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.json(path).withColumn("source_file", F.col("_metadata.file_path"))
    return spark.read.schema(RAW_SCHEMA).options(**RAW_JSON_OPTIONS).option("mode", mode).json(path)


def route_objects(df: DataFrame, name_col: str, prefix: str, suffix: str = ".json") -> DataFrame:
    """Classify object names ``<prefix>YYYY/MM/DD/<file>``: outside the prefix or not
    ``.json`` -> ignored; not exactly 5 parts or no valid date -> quarantined;
    otherwise accepted with its batch date."""
    parts = path_parts(name_col)
    in_scope = F.col(name_col).startswith(prefix) & F.col(name_col).endswith(suffix)
    day = F.try_to_date(F.concat_ws("-", parts[1], parts[2], parts[3]), "yyyy-MM-dd")
    five = F.size(parts) == 5
    route = (F.when(~in_scope, F.lit(IGNORED))
              .when(~five | day.isNull(), F.lit(QUARANTINED))
              .otherwise(F.lit(ACCEPTED)))
    return df.withColumn("route", route) \
             .withColumn("batch_date", F.when(F.col("route") == ACCEPTED, day))
