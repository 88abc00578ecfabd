"""Token ids in files of fixed-width bit-packed blocks."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import ChunkEncoder, batched, cut, scratch, small_batches, text_of

# The file layout. All numbers little-endian.
#   header   magic(8) width(u4) block(u4) n_ids(u8) n_docs(u8) n_blocks(u8)
#   blocks   n_blocks + 1 offsets (u8) into the packed area, in bytes
#   docs     n_docs keys (i8), then n_docs + 1 id offsets (u8)
#   packed   each block's ids, ``width`` bits each, lowest bit first, padded to whole bytes
MAGIC = b"SNAPIDS1"
HEADER = struct.Struct("<8sIIQQQ")


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` at ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack(raw: bytes | memoryview, width: int, n: int) -> np.ndarray:
    """The first ``n`` ids of a packed block, as unsigned 32-bit."""
    if width in (8, 16, 32):
        return np.frombuffer(raw, f"<u{width // 8}", n).astype("<u4")
    bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=n * width, bitorder="little")
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits.reshape(n, width)
    return np.packbits(full.ravel(), bitorder="little").view("<u4")


def encode_file(ids: np.ndarray, keys: np.ndarray, sizes: np.ndarray, width: int,
                block: int = 4096) -> bytes:
    """One file: ``sizes[i]`` ids belong to the document ``keys[i]``."""
    parts = [pack(ids[i:i + block], width) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0] + [len(p) for p in parts]).astype("<u8")
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    return b"".join([HEADER.pack(MAGIC, width, block, len(ids), len(keys), len(parts)),
                     offsets.tobytes(), np.asarray(keys, "<i8").tobytes(), starts.tobytes(), *parts])


class TokenFile:
    """Random access to a file's bytes: ids of any range, of any document, touching only the
    blocks that hold them."""

    def __init__(self, raw: bytes) -> None:
        magic, self.width, self.block, self.n_ids, self.n_docs, blocks = HEADER.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        at = HEADER.size
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.keys = np.frombuffer(raw, "<i8", self.n_docs, at)
        at += 8 * self.n_docs
        self.starts = np.frombuffer(raw, "<u8", self.n_docs + 1, at)
        self.packed = memoryview(raw)[at + 8 * (self.n_docs + 1):]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        if hi <= lo:
            return np.zeros(0, "<u4")
        first, last = lo // self.block, (hi - 1) // self.block
        n = min(self.n_ids, (last + 1) * self.block) - first * self.block
        if self.block * self.width % 8 == 0:        # blocks follow without gaps: one unpack
            raw = self.packed[int(self.offsets[first]):int(self.offsets[last + 1])]
            got = unpack(raw, self.width, n)
        else:
            got = np.concatenate([
                unpack(self.packed[int(self.offsets[b]):int(self.offsets[b + 1])], self.width,
                       min(self.block, self.n_ids - b * self.block))
                for b in range(first, last + 1)])
        return got[lo - first * self.block:hi - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, kind: str) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary; its memory of chunks lives across tasks."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = ChunkEncoder(path, kind)
    return _ENCODERS[path, kind]


MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("n_ids", T.LongType()),
])


def _writer(out: str, model: str, kind: str, end_id: int, file_ids: int, block: int) -> Callable:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext
        store, base = fs.FileSystem.from_uri(out)
        part = TaskContext.get().partitionId()
        enc = encoder(model, kind)
        width = bits_for(max(enc.vocab, end_id + 1))
        held: list[tuple] = []
        count, seq = 0, 0

        def flush() -> pd.DataFrame:
            nonlocal held, count, seq
            ids = np.concatenate([h[0] for h in held])
            data = encode_file(ids, np.concatenate([h[1] for h in held]),
                               np.concatenate([h[2] for h in held]), width, block)
            # The name is this attempt's own: a repeated task leaves a file no manifest names.
            name = f"part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(data)
            row = pd.DataFrame({"part": [part], "seq": [seq], "file": [f"{out}/{name}"],
                                "n_ids": [len(ids)]})
            held, count, seq = [], 0, seq + 1
            return row

        for pdf in frames:
            texts = pdf["text"].tolist()
            keys = pdf["key"].to_numpy(np.int64)
            for lo, hi in batched(texts):
                ids, sizes = enc.encode(texts[lo:hi])
                ids = np.insert(ids.astype(np.uint32), np.cumsum(sizes), end_id)
                held.append((ids, keys[lo:hi], sizes + 1))
                count += len(ids)
                if count >= file_ids:
                    yield flush()
        if held:
            yield flush()
    return run


def write_token_files(docs: DataFrame, out: str, model: str, kind: str, end_id: int, *,
                      key: str = "doc_id", text: str = "text", file_ids: int = 1 << 21,
                      block: int = 4096) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write the ids in ascending ``key`` order
    to files under ``out``, a folder all executors share. Returns the manifest: one row per
    file, whose (part, seq) order is the key order.

    Documents are dealt out by ranges of (key, hash of the text), so a repeated key spreads over
    tasks and no text is sampled for the ranges, and
    a task holds one file of about ``file_ids`` ids at a time. The manifest is cut to the shared folder:
    only files it names count, so a task that ran twice cannot add ids twice. A null text is the
    empty text and still gets its end id. Null keys come first and are stored as the smallest
    64-bit number. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    n = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    rows = (docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("key"),
                        text_of(text).alias("text"))
            .repartitionByRange(int(n), "key", F.xxhash64("text"))
            .sortWithinPartitions("key", F.xxhash64("text"), "text"))
    return cut(rows.mapInPandas(_writer(out, model, kind, end_id, file_ids, block), MANIFEST),
               "token-files")


READ = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
])


def _reader(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for raw, before in zip(pdf["content"], pdf["before"]):
            f = TokenFile(raw)
            ids = f.ids(0, f.n_ids).tobytes()
            at = f.starts.astype(np.int64)
            view = memoryview(ids)
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(at.tolist(), at[1:].tolist())]
            yield pd.DataFrame({"key": f.keys, "start": at[:-1] + int(before),
                                "n_tokens": np.diff(at), "ids_crc32": crc})


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Per document, from the files: its key, the ids before it in the whole corpus, its number
    of ids and their checksum. The running count is over one row per file."""
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    before = manifest.select(F.element_at(F.split("file", "/"), -1).alias("name"),
                             F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("before"))
    names = manifest.select("file").first()
    if names is None:
        return spark.createDataFrame([], READ)
    folder = names[0].rsplit("/", 1)[0]
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))
    # The join is by name against one narrow row per file; contents do not move when it is broadcast.
    return files.join(F.broadcast(before), "name").mapInPandas(_reader, READ)


def token_files(docs: DataFrame, model: str, kind: str, end_id: int, **kw) -> DataFrame:
    """Write and read back: see :func:`write_token_files` and :func:`read_token_files`."""
    spark = docs.sparkSession
    out = scratch(spark, "ids")
    p = spark._jvm.org.apache.hadoop.fs.Path(out)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    if ":" not in out:
        out = f"file://{out}"
    return read_token_files(spark, write_token_files(docs, out, model, kind, end_id, **kw))
