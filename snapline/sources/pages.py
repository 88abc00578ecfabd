"""Paged snapshots (S9, P9): landed API pages -> records, plus a completeness check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Fixed value: records per API page.
PAGE_SIZE = 100


def explode_pages(pages: DataFrame, record_schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """Page documents -> one row per record (``from_json`` + ``explode``)."""
    s = T.StructType([T.StructField("results", T.ArrayType(record_schema))])
    return pages.select(*keep, F.explode(F.from_json("doc", s)["results"]).alias("_r")) \
                .select(*keep, "_r.*")


def snapshot_completeness(pages: DataFrame, cycle: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per cycle: pages, records and whether the snapshot is complete — pages
    numbered 0..n-1 without gaps, every page but the last full, the last one short
    (or empty). A fetch error mid-way leaves a full last page or a gap: truncated."""
    sz = F.size(F.from_json("doc", "results array<string>")["results"])
    p = pages.select(cycle, "page_no", sz.alias("n"))
    g = p.groupBy(cycle).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.sum("n").cast("bigint").alias("n_records"),
        F.max("page_no").alias("_last"),
        F.max_by("n", "page_no").alias("_last_n"),
        F.sum(F.when(F.col("n") < page_size, 1).otherwise(0)).alias("_short"),
    )
    complete = ((F.col("n_pages") == F.col("_last") + 1)
                & (F.col("_last_n") < page_size) & (F.col("_short") == 1))
    return g.select(cycle, "n_pages", "n_records", complete.alias("complete"))


def drop_empty_snapshots(pages: DataFrame, cycle: str) -> DataFrame:
    """Leave out the pages of cycles without a single record (a poll that returned
    nothing publishes nothing)."""
    sz = F.size(F.from_json("doc", "results array<string>")["results"])
    filled = pages.groupBy(cycle).agg(F.max(sz).alias("_most")).filter(F.col("_most") > 0).select(cycle)
    return pages.join(filled, cycle, "left_semi")
