"""Vector code compression: product codes whose codebooks are fitted with norm-of-sum bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import cut, drop_path, scratch, small_batches

# Components are held within this range, so that squared distances of whole vectors of up to 64
# parts stay below 2**63. It stands for 32768.0 at the usual scale of 4096.
LIMIT = 1 << 27
# Entries of a codebook are bounded in groups of this many.
GROUP = 4
# Label totals of at most this many labels are sent to every task; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000

_VECTORS = [T.StructField("vec_id", T.LongType()), T.StructField("label", T.LongType()),
            T.StructField("x", T.BinaryType())]
# What a vector remembers of its parts: the entry each belongs to, an upper bound of the distance
# to it and lower bounds of the distances to the groups of other entries, and the round of each.
_MEMORY = [T.StructField(c, T.BinaryType()) for c in ("own", "upper", "upper_round", "lower", "lower_round")]
_SUMS = T.StructField("sums", T.ArrayType(T.LongType()))
STATE = T.StructType([*_VECTORS, *_MEMORY, _SUMS])
CODES = T.StructType([*_VECTORS[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])


def whole(vectors: DataFrame, scale: int, width: int) -> DataFrame:
    """(vec_id, label, x): components as floored multiples of 1/``scale``, 32 bits each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.zeros((b.num_rows, width), "<i4")
            for i, v in enumerate(b.column("embedding")):
                c = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                x[i, :len(c)] = np.clip(np.floor(c * scale), -LIMIT, LIMIT)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["vec_id", "label", "x"])
    return vectors.mapInArrow(run, T.StructType(_VECTORS))


def _matrix(column: pa.Array, dtype: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), *shape)


def _blobs(a: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(a)], pa.binary())


def _down(a: np.ndarray) -> np.ndarray:
    return np.nextafter(a.astype(np.float32), np.float32(-np.inf))


def _up(a: np.ndarray) -> np.ndarray:
    return np.nextafter(a.astype(np.float32), np.float32(np.inf))


class Bounds:
    """Assignment of vector parts to the nearest entries of their codebooks at one round.

    ``history`` holds the codebooks of all rounds so far, (round, part, entry, component). A bound
    keeps the round it was found in, and is moved by how far the entries lie today from where they
    lay then: the norm of the sum of their steps, which is never more than the sum of the norms.
    """

    def __init__(self, history: np.ndarray) -> None:
        self.history = history
        self.now = len(history) - 1
        self.books = history[-1]
        self.parts, self.entries, self.width = self.books.shape
        self.groups = -(-self.entries // GROUP)
        step = (self.books[None].astype(np.float64) - history) ** 2
        # Rounded up a little: sums and roots of floating point numbers.
        self.moved = np.sqrt(step.sum(axis=3)) * (1 + 1e-9)                 # round, part, entry
        padded = np.zeros((len(history), self.parts, self.groups * GROUP))
        padded[:, :, :self.entries] = self.moved
        self.group_moved = padded.reshape(len(history), self.parts, self.groups, GROUP).max(axis=3)

    def distances(self, x: np.ndarray, part: np.ndarray, entry: np.ndarray) -> np.ndarray:
        """Exact squared distances."""
        d = x - self.books[part, entry]
        return np.einsum("...i,...i->...", d, d)

    def first(self, x: np.ndarray) -> tuple[np.ndarray, ...]:
        """Assignment without anything remembered: all distances."""
        n = len(x)
        d = np.stack([self.distances(x, np.arange(self.parts), np.full(self.parts, j))
                      for j in range(self.entries)], axis=2)                # vector, part, entry
        own = d.argmin(axis=2)
        upper = _up(np.sqrt(np.take_along_axis(d, own[:, :, None], 2)[:, :, 0]))
        far = np.full((n, self.parts, self.groups * GROUP), np.inf)
        far[:, :, :self.entries] = np.sqrt(d)
        np.put_along_axis(far, own[:, :, None], np.inf, 2)
        lower = _down(far.reshape(n, self.parts, self.groups, GROUP).min(axis=3))
        stamp = np.full((n, self.parts), self.now, np.uint8)
        return (own.astype(np.uint8), upper, stamp, lower,
                np.full((n, self.parts, self.groups), self.now, np.uint8))

    def again(self, x: np.ndarray, own: np.ndarray, upper: np.ndarray, upper_round: np.ndarray,
              lower: np.ndarray, lower_round: np.ndarray) -> tuple[np.ndarray, ...]:
        """Assignment from what is remembered; parts and groups that the bounds rule out are not
        looked at. Exact squared distances decide, ties go to the lower index."""
        own, upper, upper_round, lower, lower_round = (
            a.copy() for a in (own, upper, upper_round, lower, lower_round))
        every = np.arange(self.parts)
        reach = upper + self.moved[upper_round, every, own]
        floor = lower - self.group_moved[lower_round, every[:, None], np.arange(self.groups)]
        row, part = np.nonzero((floor <= reach[:, :, None]).any(axis=2))
        # Near ones: first the exact distance to the own entry, then only groups still in reach.
        old = own[row, part].astype(np.int64)
        near = self.distances(x[row, part], part, old)
        upper[row, part] = _up(np.sqrt(near))
        upper_round[row, part] = self.now
        scan, group = np.nonzero(floor[row, part] <= upper[row, part][:, None])
        found = np.full((len(row), self.groups * GROUP), np.iinfo(np.int64).max)
        for k in range(GROUP):
            entry = group * GROUP + k
            some = entry < self.entries
            i = scan[some]
            found[i, entry[some]] = self.distances(x[row[i], part[i]], part[i], entry[some])
        found[np.arange(len(row)), old] = near
        new = found.argmin(axis=1)
        # The entry left behind is one of its group's from now on.
        left = np.flatnonzero(new != old)
        r, p, g = row[left], part[left], old[left] // GROUP
        lower[r, p, g] = np.minimum(_down(floor[r, p, g]), _down(np.sqrt(near[left])))
        lower_round[r, p, g] = self.now
        # Scanned groups: the nearest of their entries but the new own one.
        far = found.astype(np.float64)
        far[found == np.iinfo(np.int64).max] = np.inf
        far = np.sqrt(far)
        far[np.arange(len(row)), new] = np.inf
        far = far.reshape(len(row), self.groups, GROUP).min(axis=2)
        lower[row[scan], part[scan], group] = _down(far[scan, group])
        lower_round[row[scan], part[scan], group] = self.now
        own[row, part] = new
        upper[row, part] = _up(np.sqrt(found[np.arange(len(row)), new]))
        return own, upper, upper_round, lower, lower_round


def _assign(state: DataFrame, history: np.ndarray, remembered: bool) -> DataFrame:
    """One round over all vectors: the state with today's assignment, and one row a task with the
    sums and counts of its parts by entry."""
    shared = state.sparkSession.sparkContext.broadcast(history)
    parts, entries, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(shared.value)
        total = np.zeros((parts, entries, width + 1), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), "<i4", parts, width).astype(np.int64)
            memory = bounds.first(x) if not remembered else bounds.again(
                x, _matrix(b.column("own"), "u1", parts), _matrix(b.column("upper"), "<f4", parts),
                _matrix(b.column("upper_round"), "u1", parts), _matrix(b.column("lower"), "<f4", parts, bounds.groups),
                _matrix(b.column("lower_round"), "u1", parts, bounds.groups))
            np.add.at(total, (np.arange(parts), memory[0]), np.concatenate([x, np.ones_like(x[:, :, :1])], axis=2))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in _VECTORS], *map(_blobs, memory), pa.nulls(b.num_rows, pa.list_(pa.int64()))],
                STATE.names)
        none = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary()) for _ in range(6)]]
        yield pa.RecordBatch.from_arrays([*none, pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], STATE.names)

    return state.mapInArrow(run, STATE)


def _codes(state: DataFrame, history: np.ndarray) -> DataFrame:
    """The last assignment: (vec_id, label, code, error)."""
    shared = state.sparkSession.sparkContext.broadcast(history)
    parts, _, width = history.shape[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(shared.value)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"), "<i4", parts, width).astype(np.int64)
            own = bounds.first(x)[0] if "own" not in b.schema.names else bounds.again(
                x, _matrix(b.column("own"), "u1", parts), _matrix(b.column("upper"), "<f4", parts),
                _matrix(b.column("upper_round"), "u1", parts), _matrix(b.column("lower"), "<f4", parts, bounds.groups),
                _matrix(b.column("lower_round"), "u1", parts, bounds.groups))[0]
            error = bounds.distances(x, np.arange(parts), own).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), pa.array([r.tobytes().hex() for r in own]), pa.array(error)],
                CODES.names)

    return state.mapInArrow(run, CODES)


def compress(vectors: DataFrame, *, vector: str = "embedding", parts: int = 8, entries: int = 16, rounds: int = 6,
             scale: int = 4096) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept vector.

    Vectors that are null, or hold null or non-finite components, are dropped. Components become
    whole numbers, floor(``scale`` x); vectors are cut into ``parts`` equal parts with a codebook
    each, which starts as that part of the ``entries`` smallest ids (repeated ids: smaller vector
    first; null ids last) and is moved ``rounds`` times to the floored means of its parts. Ties go
    to the lower entry, unused entries stay.

    Between rounds a vector keeps bounds of its distances, each with the round it was found in;
    see :class:`Bounds`. A round is one pass over the vectors with no shuffle but that of one row of
    sums a task; its state is a table in the shared folder, and the table before it goes once the
    next one stands. What reaches the driver are the first vectors and one number an entry's
    component and round. Fewer vectors than entries make smaller codebooks. Shorter vectors than
    the longest, or lengths that the parts do not divide, are filled with zeros at the end.
    Numbers beyond ``LIMIT`` are held at it. ``label_error`` is the error summed over a
    vector's label (null is one). Repeated rows stay. No rows, no result. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256: two hex digits each")
    if not 0 <= rounds < 255:
        raise ValueError("rounds must be below 255: one byte holds a round")
    finite = F.forall(F.col(vector), lambda v: F.coalesce((F.abs(v) < float("inf")) & ~F.isnan(v), F.lit(False)))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("embedding")).where(
        F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    path = scratch(spark, "vector-codes")
    whole(kept, scale, parts * width).write.option("compression", "zstd").parquet(path)
    state = spark.read.schema(T.StructType(_VECTORS)).parquet(path)
    seeds = state.select("vec_id", "x").orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    if not seeds:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books = np.stack([np.frombuffer(r["x"], "<i4").reshape(parts, width) for r in seeds], axis=1).astype(np.int64)
    history = books[None]
    for i in range(rounds):
        _assign(state, history, i > 0).write.option("compression", "zstd").parquet(f"{path}-{i}")
        if i:
            drop_path(spark, f"{path}-{i - 1}")
        else:
            drop_path(spark, path)
        written = spark.read.schema(STATE).parquet(f"{path}-{i}")
        got = (written.where("sums is not null").select(F.posexplode("sums").alias("at", "n"))
               .groupBy("at").agg(F.sum("n").alias("n")).collect())
        total = np.zeros(books.size // width * (width + 1), np.int64)
        for r in got:
            total[r["at"]] = r["n"]
        total = total.reshape(*books.shape[:2], width + 1)
        used = total[:, :, width:] > 0
        books = np.where(used, total[:, :, :width] // np.maximum(total[:, :, width:], 1), books)
        history = np.concatenate([history, books[None]])
        state = written.where("x is not null").drop("sums")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = cut(_codes(state, history), "vector-codes")
    drop_path(spark, f"{path}-{rounds - 1}" if rounds else path)
    labels = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    labels = cut(labels, "vector-labels").withColumnRenamed("label", "_label")
    few = labels.count() <= BROADCAST_LABELS
    return (codes.join(F.broadcast(labels) if few else labels, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
