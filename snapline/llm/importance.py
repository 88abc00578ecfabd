"""Target-distribution importance resampling over hashed words and word pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import batched, cut, joined_bytes, partitions_for, small_batches, text_of

# Bytes a span may have before it is folded block by block.
BLOCK = 64
_POLY = np.uint32(0xEDB88320)
ALL_ONES = np.uint32(0xFFFFFFFF)
COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What byte b adds to a CRC register when d more bytes follow it (row d, column b), and the
    register after L zero bytes from all ones (entry L): the part that only the length decides."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> np.uint32(1)) ^ _POLY, row >> np.uint32(1))
    after = np.empty((BLOCK, 256), np.uint32)
    after[0] = row
    for d in range(1, BLOCK):
        after[d] = (after[d - 1] >> np.uint32(8)) ^ row[after[d - 1] & 255]
    zeros = np.empty(BLOCK + 1, np.uint32)
    zeros[0] = ALL_ONES
    for n in range(BLOCK):
        zeros[n + 1] = (zeros[n] >> np.uint32(8)) ^ row[zeros[n] & 255]
    return after, zeros


_AFTER, _ZEROS = _tables()


def _advance(register: np.ndarray) -> np.ndarray:
    """Registers after ``BLOCK`` more zero bytes: their four bytes stand before the block's last ones."""
    out = np.zeros_like(register)
    for i in range(4):
        out ^= _AFTER[BLOCK - 1 - i][(register >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def _raw(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Register contribution of each span (1 to ``BLOCK`` bytes): the table entries of its bytes
    by their distance from its end, joined by exclusive or."""
    if not len(start):
        return np.zeros(0, np.uint32)
    first = np.cumsum(size) - size
    if first[-1] + size[-1] > 1 << 21:                         # in parts that stay in the cache
        half = len(start) // 2
        if half:
            return np.concatenate([_raw(buf, start[:half], size[:half]), _raw(buf, start[half:], size[half:])])
    place = np.arange(first[-1] + size[-1], dtype=np.int32)
    place += np.repeat((start - first).astype(np.int32), size)
    entry = np.repeat((start + size - 1).astype(np.int32), size)
    entry -= place                                             # bytes that follow
    entry <<= 8
    entry |= buf[place]
    return np.bitwise_xor.reduceat(_AFTER.ravel()[entry], first)


def crc32_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each non-empty byte span ``buf[start:end]``. A span of at most ``BLOCK`` bytes is
    one exclusive or of table entries and its length's constant; a longer one is folded in blocks
    counted from its end, all long spans of equal rank at once."""
    size = end - start
    out = np.empty(len(start), np.uint32)
    short = size <= BLOCK
    s = np.flatnonzero(short)
    out[s] = _raw(buf, start[s], size[s]) ^ _ZEROS[size[s]]
    left = np.flatnonzero(~short)
    if len(left):
        at, stop = start[left].copy(), end[left]
        head = (size[left] - 1) % BLOCK + 1                    # the rest are whole blocks
        register = _raw(buf, at, head) ^ _ZEROS[head]
        at += head
        while len(left):
            register = _advance(register) ^ _raw(buf, at, np.full(len(at), BLOCK))
            at += BLOCK
            done = at >= stop
            out[left[done]] = register[done]
            left, at, stop, register = left[~done], at[~done], stop[~done], register[~done]
    return out ^ ALL_ONES


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)
_WORD = np.ones(256, bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _WORD[_lo:_hi + 1] = False


def feature_buckets(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the buckets of all features (words, then pairs of neighbours joined
    by a space) with the number of the text each is of. Words are runs of letters, digits and
    everything beyond ASCII, after A-Z became a-z."""
    raw, begin = joined_bytes(texts)
    buf = _FOLD[raw]
    inside = np.concatenate([[False], _WORD[buf], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    owner = np.searchsorted(begin, start, "right") - 1
    near = np.flatnonzero(owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, np.int64)
    # All words with one space after each, whatever stood there: words and pairs are spans of it.
    line = buf.copy()
    line[end] = 32
    kept = inside[1:-1].copy()
    kept[end] = True
    line = line[kept]
    end = np.cumsum(end - start + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    code = crc32_spans(line, np.concatenate([start, start[near]]), np.concatenate([end, end[near + 1]]))
    return (np.bincount(owner, minlength=len(texts)), code % np.uint32(buckets),
            np.concatenate([owner, owner[near]]))


def bucket_counts(docs: DataFrame, buckets: int, text: str = "text") -> DataFrame:
    """(bucket, n): how many features of all whole texts fall into each bucket. Every task adds
    up its own texts first, so a shuffle carries one row a task and bucket."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for pdf in frames:
            texts = pdf["text"].tolist()
            for lo, hi in batched(texts):
                total += np.bincount(feature_buckets(texts[lo:hi], buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some.astype(np.int32), "n": total[some]})

    return (docs.select(text_of(text).alias("text")).mapInPandas(run, COUNTS)
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Per bucket floor(1000 ln(share in the target / share in the source)), shares with one
    feature more in every bucket. Only the buckets' totals reach the driver."""
    def totals(df: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for r in df.collect():
            out[r["bucket"]] = r["n"]
        return out

    s, t = totals(source), totals(target)
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + float(buckets))) / ((s + 1) * (t.sum() + float(buckets))))).astype(np.int64)


def _weighed(docs: DataFrame, gain: np.ndarray, text: str) -> DataFrame:
    """``docs`` with n_words, n_features and weight."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    added = ["n_words", "n_features", "weight"]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in added]])
    kept = [f.name for f in schema.fields if f.name not in (text, *added)]
    schema = T.StructType([f for f in schema.fields if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            found = [(np.zeros(0, np.int64),) * 3]
            for lo, hi in batched(texts):
                words, bucket, owner = feature_buckets(texts[lo:hi], len(g))
                n = np.bincount(owner, minlength=hi - lo)
                total = np.bincount(owner, g[bucket], hi - lo).astype(np.int64)      # whole numbers, far below 2**53
                found.append((words, n, total // np.maximum(n, 1)))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept],
                                              *[pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)]],
                                             [*kept, *added])

    return docs.mapInArrow(run, schema)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the hash of the seed and the key as text."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8),
               16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(df: DataFrame, order: list[Column], out: str, rows_a_task: int = 500_000) -> DataFrame:
    """``df`` with its place (1, 2, 3 ...) in ``order``: sorted in ranges, numbered inside each,
    and moved by the rows of the ranges before it, of which there is one row each."""
    spark = df.sparkSession
    n = partitions_for(df.count(), rows_a_task, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cut(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("_at", F.monotonically_increasing_id()), "importance-order")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = sizes.select("_part", (F.sum("_rows").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    return (placed.withColumn("_part", part).join(before, "_part")
            .withColumn(out, F.coalesce("_before", F.lit(0)) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_part", "_before", "_at"))


def resample(docs: DataFrame, target: DataFrame, *, text: str = "text", buckets: int = 10_000, least_words: int = 20,
             percent: int = 25, seed: int = 7) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document.

    ``weight`` is the floored mean, over the document's features, of how much likelier their
    buckets are in ``target`` than in ``docs`` (thousandths of the logarithm); ``score`` adds
    Gumbel noise, so that the highest scores are a sample without replacement by weight. Of the
    documents with ``least_words`` words, floor(percent/100) of their number are drawn; ``rank``
    is their order (ties: smaller id; null ids last), null for the others.

    Two scans of the texts (totals, weights); texts are never shuffled. Null texts are empty
    texts: no features, weight 0. A null id hashes as the empty text. Rows with equal ids and
    scores take neighbouring ranks. An empty target leaves every bucket one feature. Columns
    other than the id and the text are ignored. No rows, no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col(text).alias("text"))
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets, text), buckets)
    scored = cut(_weighed(docs, gain, "text").withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    in_order = ranked(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], "rank")
    return (in_order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
            .unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))))
