"""Helpers the operators of this package share: scratch tables, safe column names, text encoders."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.session import checkpoint_dir


# Stands for a missing id inside operators, so that ids never pass through floating point.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; every call gives another one."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and a lost
    executor costs only a re-read."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a finished scratch table, whatever file system it lives on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand Python workers at most ``rows`` rows at a time: texts are wide, and a worker keeps
    the memory of its largest batch. A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_of(col: str = "text"):
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def partitions_for(total: float, each: float, least: int = 1) -> int:
    """How many tasks ``total`` units need at ``each`` units a task: grows with the data."""
    return max(least, -(-int(total) // max(1, int(each))))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's vocabulary file, from the installed package."""
    import public_tokenizers
    return public_tokenizers.path(name)


def id_width(vocab_size: int) -> np.dtype:
    return np.dtype("<u2") if vocab_size <= 1 << 16 else np.dtype("<u4")


_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _MULT)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]          # A-Z hash as a-z


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for i, m in enumerate((_MULT, _INV)):
            p = np.full(size, m, np.uint64)
            p[0] = 1
            _POWERS[i:i + 1] = [np.multiply.accumulate(p)]
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each byte span ``buf[start:end]``, without a loop over spans."""
    up, down = _powers(len(buf) + 1)
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[buf] * up[:-1], out=run[1:])
    return mix64((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(","), ord(".")]] = True


def joined_bytes(texts: list[str], sep: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts with ``sep`` after each, and the offset where each text begins."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    ends = np.cumsum(np.fromiter((len(r) + len(sep) for r in raw), np.int64, len(raw)))
    return (np.frombuffer(sep.join(raw) + sep, np.uint8),
            np.concatenate([[0], ends]).astype(np.int64))


def words_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes outside ASCII white space."""
    gap = np.concatenate([[True], _SPACE[buf], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


# What a chunk may begin and end with so that no vocabulary takes its edge for white space,
# and chunks that keep their character offsets in every normaliser.
_SOLID = re.compile(r"[!-~\u00a1-\u167f\u1681-\u180d\u1810-\u1fff\u2070-\u2fff"
                    r"\u3001-\ufefe\U00010000-\U0010ffff]")
_PLAIN = re.compile(r"[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


class ChunkEncoder:
    """Ids of whole texts from a ``tokenizers`` file, with each distinct chunk encoded once.

    Both vocabularies cut a text into pre-tokens before merging, and no pre-token crosses the
    places used here, so the ids of a text are the ids of its chunks in order. Both kinds cut
    before a comma or full stop after an ASCII letter. ``kind="word"`` (white space dropped by
    the vocabulary) also cuts at every run of ASCII white space. ``kind="byte"`` (a space
    belongs to the word after it) also cuts before each space, and around a line break between
    a comma or full stop and an ASCII letter; a text in which such a chunk does not begin and
    end with a visible character goes to the library whole. The memory of chunks holds
    ``limit`` entries at most and starts again beyond that.
    """

    def __init__(self, path: str, kind: str, limit: int = 1_500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.vocab = self.tok.get_vocab_size()
        self.dtype = id_width(self.vocab)
        self.kind = kind
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)          # hashes of known chunks, ascending,
        self.slot = np.zeros(0, np.int64)           # and their places in start and length
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int32)
        self.pool = np.zeros(1 << 18, self.dtype)
        self.used = 0

    def library(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts, straight from the library."""
        return [e.ids for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _chunk_ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk; plain chunks go to the library many in one text."""
        sep = " " if self.kind == "word" else ""
        out: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks)
                 if (_PLAIN.fullmatch(c) if sep else c[0] == " " and _PLAIN.fullmatch(c, 1))]
        for lo in range(0, len(plain), 256):
            group = plain[lo:lo + 256]
            begins = np.cumsum([0] + [len(chunks[i]) + len(sep) for i in group])
            enc = self.tok.encode(sep.join(chunks[i] for i in group), add_special_tokens=False)
            ids = enc.ids
            # A token belongs to the chunk its last character is in.
            last = np.fromiter((b for _, b in enc.offsets), np.int64, len(ids)) - 1
            cuts = np.searchsorted(last, begins).tolist()
            for i, a, b in zip(group, cuts, cuts[1:]):
                out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self.library([chunks[i] for i in rest]) if rest else []):
            out[i] = ids
        return out

    def _safe(self, c: str) -> bool:
        if self.kind == "word" or c == "\n":
            return True
        w = c[1:] if c[0] == " " else c
        return bool(w and _SOLID.match(w[0]) and _SOLID.match(w[-1]))

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of chunk hashes, -1 for unknown ones."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.slot[at], -1)

    def _learn(self, hashes: np.ndarray, chunks: list[str]) -> None:
        """Store the ids of new chunks; one whose edge is not visible gets length -1."""
        solid = [i for i, c in enumerate(chunks) if self._safe(c)]
        found: dict[int, list[int]] = dict(zip(solid, self._chunk_ids([chunks[i] for i in solid])))
        n, base = len(chunks), len(self.keys)
        while base + n > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        lens = np.fromiter((len(found[i]) if i in found else -1 for i in range(n)), np.int32, n)
        flat = np.fromiter((x for i in range(n) for x in found.get(i, ())), self.dtype)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        full = np.maximum(lens, 0)
        self.start[base:base + n] = self.used + np.cumsum(full) - full
        self.length[base:base + n] = lens
        self.used += len(flat)
        order = np.argsort(hashes)
        place = np.searchsorted(self.keys, hashes[order])
        self.keys = np.insert(self.keys, place, hashes[order])
        self.slot = np.insert(self.slot, place, base + order)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        if len(self.keys) > self.limit:
            self._forget()
        start, stop, first, buf = self._cut(texts)
        if not len(start):
            return np.zeros(0, self.dtype), np.zeros(len(texts), np.int64)
        count = np.diff(np.concatenate([first, [len(start)]]))
        code, uniq = pd.factorize(span_hashes(buf, start, stop))
        slot = self._find(uniq)
        new = np.flatnonzero(slot < 0)
        if len(new):
            seen = np.zeros(len(uniq), np.int64)
            seen[code[::-1]] = np.arange(len(code))[::-1]     # first place of each chunk
            raw, place = buf.tobytes(), seen[new]
            self._learn(uniq[new], [raw[a:b].decode("utf-8", "surrogatepass")
                                    for a, b in zip(start[place].tolist(), stop[place].tolist())])
            slot = self._find(uniq)
        which = slot[code]
        run, lens = self.start[which], self.length[which].astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), count)
        odd = np.unique(owner[lens < 0])                      # texts for the library, whole
        lens[np.isin(owner, odd) if len(odd) else slice(0, 0)] = 0
        total = int(lens.sum())
        ids = self.pool[np.repeat(run - (np.cumsum(lens) - lens), lens) + np.arange(total)]
        sizes = np.bincount(owner, lens, len(texts)).astype(np.int64)
        if len(odd):
            found = self.library([texts[i] for i in odd])
            more = np.fromiter((len(x) for x in found), np.int64, len(found))
            ids = np.insert(ids, np.repeat((np.cumsum(sizes) - sizes)[odd], more),
                            np.fromiter((x for e in found for x in e), self.dtype))
            sizes[odd] = more
        return ids, sizes

    def _cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunk starts and ends, the first chunk of each text, and the bytes they are in."""
        word = self.kind == "word"
        buf, at = joined_bytes(texts, b" " if word else b"")
        if not len(buf):
            none = np.zeros(0, np.int64)
            return none, none, none, buf
        cut = np.zeros(len(buf) + 1, bool)                    # a chunk may begin here
        cut[1:-1] = _STOP[buf[1:]] & _LETTER[buf[:-1]]
        if word:
            gap = _SPACE[buf]
            cut[0] = True
            cut[1:-1] |= gap[:-1]
            start = np.flatnonzero(cut[:-1] & ~gap)
            ends = cut[1:] | np.concatenate([gap[1:], [True]])
            stop = np.flatnonzero(ends & ~gap) + 1
        else:
            line = np.flatnonzero((buf[1:-1] == 10) & _STOP[buf[:-2]] & _LETTER[buf[2:]]) + 1
            cut[line] = cut[line + 1] = True
            cut[:-1] |= buf == 0x20
            cut[at] = True
            start = np.flatnonzero(cut[:-1])
            stop = np.concatenate([start[1:], [len(buf)]])
        return start, stop, np.searchsorted(start, at[:-1]), buf


def batched(texts: list[str], chars: int = 1 << 19) -> Iterable[tuple[int, int]]:
    """Index ranges of about ``chars`` characters each, so that long texts do not pile up."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
