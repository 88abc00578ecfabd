"""Bounded-space online best-fit packing of token pieces into fixed-length sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.bitpack import encoder
from snapline.llm.common import NO_ID, batched, cut, partitions_for, small_batches, text_of

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])
PACKED = T.StructType([*PIECES.fields,
                       T.StructField("sequence_id", T.LongType()),
                       T.StructField("offset", T.LongType())])
# A piece with its document's place in a given order and its document's number of pieces.
PLACED = T.StructType([*PIECES.fields, T.StructField("_place", T.LongType()), T.StructField("_n", T.LongType())])
# Chunks of documents at most, whose counts are numbered in one window.
CHUNKS = 2000


def _pieces(model: str, kind: str, end_id: int, capacity: int, placed: bool = False):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(model, kind)
        for pdf in frames:
            texts = pdf["text"].tolist()
            keys = pdf["doc_id"]
            for lo, hi in batched(texts):
                ids, sizes = enc.encode(texts[lo:hi])
                raw = memoryview(np.insert(ids.astype("<u4"), np.cumsum(sizes), end_id).tobytes())
                sizes = sizes + 1
                n = -(-sizes // capacity)                     # pieces of each document
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                head = sizes - (n - 1) * capacity             # the first piece takes the rest
                start = np.where(piece > 0, head[doc] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[doc])
                at = ((np.cumsum(sizes) - sizes)[doc] + start) * 4
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
                out = pd.DataFrame({"doc_id": keys.iloc[lo:hi].array[doc], "piece": piece.astype(np.int32),
                                    "start": start, "length": length, "ids_crc32": crc})
                if placed:
                    out["_place"], out["_n"] = pdf["_place"].iloc[lo:hi].array[doc], n[doc]
                yield out
    return run


class OpenBins:
    """At most ``limit`` open bins of ``capacity``, found by free space through a bitset.

    Bit ``f`` is set while some open bin has ``f`` free. An item goes to the bin with the least
    free space that holds it; when none does and all bins are in use, the fullest one closes.
    A bin without free space closes at once.
    """

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        self.open -= 1
        return b

    def put(self, size: int) -> tuple[int, int]:
        """The bin and the place in it for an item of ``size``."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            b, free = self.made, self.capacity
            self.made += 1
        left = free - size
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
            self.open += 1
        return b, self.capacity - free


def _pack(capacity: int, limit: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        bins = OpenBins(capacity, limit)
        for pdf in frames:
            placed = [bins.put(s) for s in pdf["length"].tolist()]
            pdf["sequence_id"] = [base + b for b, _ in placed]
            pdf["offset"] = [o for _, o in placed]
            yield pdf
    return run


def _pack_along(capacity: int, limit: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bins = OpenBins(capacity, limit)
        pdf = pdf.sort_values("_at", kind="stable")
        placed = [bins.put(s) for s in pdf["length"].tolist()]
        pdf["sequence_id"] = [(key[0] << 40) + b for b, _ in placed]
        pdf["offset"] = [o for _, o in placed]
        return pdf[PACKED.names]
    return run


def in_row_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``, the row's number from 0 in the order it was written: by part file
    and row of the file if ``docs`` reads Parquet files, else by partition and row. A part's rows
    before it are counted, so the number does not depend on how the rows are split."""
    plan = docs._jdf.queryExecution().analyzed()
    if plan.children().isEmpty() and plan.getClass().getSimpleName() == "LogicalRelation":
        name = F.col("_metadata.file_name")
        number = F.regexp_extract(name, r"^part-([0-9]+)-.*", 1)
        further = F.regexp_extract(name, r"-c([0-9]+)[^-]*$", 1)
        part = F.concat_ws("/", F.lpad(number, 12, "0"), F.lpad(further, 12, "0"), name)
        rows = docs.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    else:
        at = F.monotonically_increasing_id()
        rows = cut(docs.withColumn("_id", at), "rows").select(
            *docs.columns, F.lpad(F.shiftright("_id", 33).cast("string"), 12, "0").alias("_part"),
            F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"))
    # One row per part file.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return (rows.join(F.broadcast(starts), "_part").withColumn("_place", F.col("_start") + F.col("_row"))
            .select(*docs.columns, "_place"))


def _pack_in_order(pieces: DataFrame, capacity: int, open_bins: int, pieces_per_task: int) -> DataFrame:
    """Pieces numbered along (_place, piece), cut into runs of ``pieces_per_task``; each run is
    packed in that order. Documents are numbered inside chunks, so no task holds them all."""
    each = max(1000, -(-(pieces.agg(F.max("_place")).first()[0] or 0) // CHUNKS))
    docs = (pieces.where("piece = 0").select("_place", "_n")
            .withColumn("_chunk", F.floor(F.col("_place") / each)))
    back = (Window.unboundedPreceding, -1)
    # One row per chunk, CHUNKS and one at most.
    chunks = docs.groupBy("_chunk").agg(F.sum("_n").alias("_pieces")).select("_chunk", F.coalesce(
        F.sum("_pieces").over(Window.orderBy("_chunk").rowsBetween(*back)), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_chunk").orderBy("_place").rowsBetween(*back)
    starts = (docs.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(F.broadcast(chunks), "_chunk").select("_place", (F.col("_start") + F.col("_in")).alias("_first")))
    return (pieces.join(starts, "_place").withColumn("_at", F.col("_first") + F.col("piece"))
            .withColumn("_run", F.floor(F.col("_at") / pieces_per_task))
            .select(*PIECES.names, "_at", "_run")
            .groupBy("_run").applyInPandas(_pack_along(capacity, open_bins), PACKED))


def best_fit_pack(docs: DataFrame, model: str, kind: str, end_id: int, *, capacity: int = 1024,
                  open_bins: int = 512, pieces_per_task: int = 100_000, in_order: bool = False) -> DataFrame:
    """Pack the ids of every whole text, each followed by ``end_id``, into sequences of at most
    ``capacity`` ids. Returns one row per piece with its place.

    Only a document longer than ``capacity`` is cut: its first piece takes the remainder and all
    others are full. Texts are encoded where they are read; what moves on is one narrow row per
    piece. Pieces are dealt out by a hash of document and piece, so a very long document spreads
    over tasks, and each task packs a stream with ``open_bins`` open bins. A task leaves at most
    ``open_bins`` sequences that are not full, so tasks get ``pieces_per_task`` pieces each,
    however large the corpus is. Pieces are sorted by a hash within a task, which makes the
    result repeatable and mixes sizes; full pieces need no bin of others.

    With ``in_order`` pieces keep the order of the rows of ``docs`` (see :func:`in_row_order`)
    instead: a task gets a run of ``pieces_per_task`` pieces along it, feeds its open bins in that
    order, and sequences are numbered along it. A long document spreads over runs, too.

    Null texts count as empty: their one id is the end id. Null and repeated keys are packed like
    any other row; columns other than ``doc_id`` and ``text`` are ignored. No rows, no pieces.
    """
    small_batches(docs.sparkSession)
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), text_of().alias("text")]
    if in_order:
        rows = in_row_order(docs).select(*own, "_place")
        pieces = cut(rows.mapInPandas(_pieces(model, kind, end_id, capacity, True), PLACED), "pieces")
        return _pack_in_order(pieces, capacity, open_bins, pieces_per_task).withColumn(
            "doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
    rows = docs.select(*own)
    pieces = cut(rows.mapInPandas(_pieces(model, kind, end_id, capacity), PIECES), "pieces")
    tasks = partitions_for(pieces.count(), pieces_per_task)
    order = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = (pieces.withColumn("_order", order).repartition(tasks, "_order")
             .sortWithinPartitions("_order", "doc_id", "piece", "start", "length").drop("_order"))
    return dealt.mapInPandas(_pack(capacity, open_bins), PACKED).withColumn(
        "doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
