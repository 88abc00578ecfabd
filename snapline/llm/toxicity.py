"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import _powers, batched, cut, mix64, small_batches, text_of

SIZES = (3, 4, 5)               # characters of a gram
BITS = 18                       # grams are hashed into 2**BITS features
STEADY = 50
# Labels of at most this many documents are sent to every task; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("feature", "toxic", "clean")])
EXAMPLES = T.StructType([T.StructField("toxic", T.BooleanType()), T.StructField("features", T.ArrayType(T.IntegerType())),
                         T.StructField("values", T.ArrayType(T.DoubleType()))])
# A task's gradient goes to the sum in this many pieces, so that no task holds all of them.
SLICES = 64
PIECES = T.StructType([T.StructField("slice", T.IntegerType()), T.StructField("part", T.IntegerType()),
                       T.StructField("sums", T.BinaryType())])


@dataclass
class Model:
    """Weight of each feature (ratio and coefficient already multiplied) and the intercept."""
    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of each text as (text number, feature, rate), ordered by the first two;
    with ``wanted`` (a flag per feature) only those. Texts are lower-cased, white space is folded,
    and a space stands at either end, so that grams tell word beginnings and endings. The rate is
    the logarithm of one plus the grams of this feature in a hundred characters, so that a text
    says the same at any length; the ``STEADY`` characters added keep short ones from extremes.
    An empty text has no feature."""
    folded = [f" {' '.join(t.lower().split())} " if t.strip() else "" for t in texts]
    size = np.fromiter(map(len, folded), np.int64, len(folded))
    cp = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), size)
    up, down = _powers(len(cp) + 1)
    run = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum((cp + np.uint64(0x51ED270B)) * up[:-1], out=run[1:])
    found = [np.zeros(0, np.int64)]
    for n in SIZES:
        count = len(cp) - n + 1
        if count <= 0:
            continue
        code = mix64((run[n:] - run[:count]) * down[:count] + np.uint64(n)) >> np.uint64(64 - BITS)
        inside = owner[:count] == owner[n - 1:]
        if wanted is not None:
            inside &= wanted[code]
        at = np.flatnonzero(inside)
        found.append((owner[at] << BITS) | code[at].astype(np.int64))
    both, times = np.unique(np.concatenate(found), return_counts=True)
    who = both >> BITS
    return who, both & ((1 << BITS) - 1), np.log1p(100 * times / (size[who] + STEADY))


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many toxic and how many clean texts of a task hold each feature."""
    held = np.zeros((2, 1 << BITS), np.int64)
    for pdf in frames:
        texts, toxic = pdf["text"].tolist(), pdf["toxic"].to_numpy(bool)
        for lo, hi in batched(texts):
            who, what, _ = features(texts[lo:hi])
            bad = toxic[lo:hi][who]
            held[0] += np.bincount(what[bad], minlength=1 << BITS)
            held[1] += np.bincount(what[~bad], minlength=1 << BITS)
    some = np.flatnonzero(held.any(axis=0))
    yield pd.DataFrame({"feature": some, "toxic": held[0, some], "clean": held[1, some]})


def ratios(counts: pd.DataFrame, toxic: int, clean: int, alpha: float, least: float,
           least_texts: int) -> np.ndarray:
    """Log ratio of the share of toxic texts that hold a feature to that of clean ones. ``alpha``
    texts with the feature are added at the overall proportion of classes, so that a feature
    never seen has ratio 0. Ratios below ``least`` and features of fewer than ``least_texts``
    texts say nothing and become 0."""
    out = np.zeros(1 << BITS)
    bad, good = counts["toxic"].to_numpy(float), counts["clean"].to_numpy(float)
    r = (np.log((bad + alpha * toxic / (toxic + clean)) / toxic)
         - np.log((good + alpha * clean / (toxic + clean)) / clean))
    r[(np.abs(r) < least) | (bad + good < least_texts)] = 0.0
    out[counts["feature"].to_numpy()] = r
    return out


def _loss(examples: DataFrame, x: np.ndarray, weight: float) -> tuple[float, np.ndarray]:
    """Logistic loss of all examples at ``x`` (coefficients, then the intercept) and its gradient;
    a toxic example counts ``weight`` times. One job: every task adds up its own examples, and the
    pieces of their sums meet by slice."""
    shared = examples.sparkSession.sparkContext.broadcast(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        at = shared.value
        total = np.zeros(len(at) + 1)                       # the gradient, then the loss
        for b in batches:
            y = b.column("toxic").to_numpy(zero_copy_only=False).astype(float)
            w = np.where(y > 0, weight, 1.0)
            lists = b.column("features")
            what = lists.flatten().to_numpy()
            value = b.column("values").flatten().to_numpy()
            who = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
            z = np.bincount(who, value * at[what], len(y)) + at[-1]
            slope = w * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
            total[:-2] += np.bincount(what, value * slope[who], len(at) - 1)
            total[-2] += slope.sum()
            total[-1] += (w * (np.logaddexp(0, z) - y * z)).sum()
        part = TaskContext.get().partitionId()
        cuts = np.array_split(total, SLICES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(np.full(SLICES, part, np.int32)),
             pa.array([c.tobytes() for c in cuts], pa.binary())], PIECES.names)

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        return pd.DataFrame({"slice": pdf["slice"][:1], "part": 0, "sums": [
            np.sum([np.frombuffer(v) for v in pdf["sums"]], axis=0).tobytes()]})

    found = examples.mapInArrow(run, PIECES).groupBy("slice").applyInPandas(add, PIECES).collect()
    shared.destroy()
    total = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(found, key=lambda r: r["slice"])])
    return float(total[-1]), total[:-1]


def fit(examples: DataFrame, toxic: int, clean: int, penalty: float, rounds: int, tol: float) -> np.ndarray:
    """Coefficients, then the intercept, of logistic regression with an L2 penalty, both classes
    with the same weight, by limited-memory quasi-Newton steps. They run over the scaled features
    as they are: scaling is what lets the telling ones move first."""
    weight, n = clean / toxic, 2.0 * clean
    x = np.zeros((1 << BITS) + 1)

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope = _loss(examples, x, weight)
        slope = slope / n
        slope[:-1] += penalty * x[:-1]
        return loss / n + penalty / 2 * float(x[:-1] @ x[:-1]), slope

    value, slope = at(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, share = slope.copy(), []
        for s, y in reversed(steps):
            share.append(s @ way / (y @ s))
            way -= share[-1] * y
        way *= steps[-1][0] @ steps[-1][1] / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1e-12, np.linalg.norm(slope))
        for (s, y), a in zip(steps, reversed(share)):
            way += s * (a - y @ way / (y @ s))
        size, gain = 1.0, float(slope @ way)
        after, turned = at(x - way)
        while after > value - 1e-4 * size * gain and size > 1e-4:
            size /= 2
            after, turned = at(x - size * way)
        if after >= value:
            break
        if (turned - slope) @ way < 0:
            steps = [*steps[-9:], (-size * way, turned - slope)]
        x = x - size * way
        done = value - after < tol * value
        value, slope = after, turned
        if done:
            break
    return x


def train(labelled: DataFrame, *, alpha: float = 1.0, least: float = 0.3, least_texts: int = 4,
          penalty: float = 1e-5, rounds: int = 40, tol: float = 3e-5) -> Model:
    """Model from ``labelled`` (text, toxic boolean), all rows of it.

    One pass counts, for every feature, the texts of either class that hold it, and a second one
    writes each text's features scaled by their ratios; logistic regression (see :func:`fit`)
    runs over that table, whose rows stay on the executors: what reaches the driver is one number
    a feature and round. Without a row of one class every text gets the other.
    """
    spark = labelled.sparkSession
    sizes = labelled.agg(F.count_if("toxic").alias("bad"), F.count_if(~F.col("toxic")).alias("good")).first()
    bad, good = sizes["bad"], sizes["good"]
    if not bad or not good:
        return Model(bias=40.0 if bad else -40.0)
    counts = labelled.mapInPandas(_count, COUNTS).groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toPandas()     # 2**BITS rows at most
    ratio = ratios(counts, bad, good, alpha, least, least_texts)
    shared = spark.sparkContext.broadcast(ratio)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        some = r != 0
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in batched(texts):
                who, what, rate = features(texts[lo:hi], some)
                ends = pa.array(np.searchsorted(who, np.arange(hi - lo + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column("toxic").slice(lo, hi - lo), pa.ListArray.from_arrays(ends, pa.array(what.astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(r[what] * rate))], EXAMPLES.names)

    examples = cut(labelled.mapInArrow(scaled, EXAMPLES), "toxicity-examples")
    x = fit(examples, bad, good, penalty, rounds, tol)
    return Model(float(x[-1]), x[:-1] * ratio)


def score(docs: DataFrame, model: Model, *, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the model's probability (0 to 1) that the whole text is toxic."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, w = shared.value
        some = w != 0
        for b in batches:
            texts = [t or "" for t in b.column(text).to_pylist()]
            z = [np.zeros(0)]
            for lo, hi in batched(texts):
                who, what, rate = features(texts[lo:hi], some)
                z.append(bias + np.bincount(who, w[what] * rate, hi - lo))
            p = 1 / (1 + np.exp(-np.clip(np.concatenate(z), -40, 40)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], [*b.schema.names, out])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, *, text: str = "text", folds: int = 3, held: int = 1,
             threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on).

    Labels whose crc32 of the id as text is ``held`` modulo ``folds`` are held out: no step reads
    them. All others train the model (see :func:`train`); a document with several labels is toxic
    if any says so, null labels do not count. The score reads the text alone. Null texts are
    empty texts, which hold no feature and get the model's intercept; a null id is never held out
    and never labelled. Repeated rows get equal results; without labels every score is 0.
    Existing columns of these three names are replaced; all others stay. No rows, no result.

    Three scans of the texts (two of the labelled ones); texts are not shuffled while labels are
    few enough to send along, see ``BROADCAST_IDS``.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("held_out", "score", "predicted")
    out = (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == held)
    known = cut(labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~out)
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxicity-labels")
    few = known.count() <= BROADCAST_IDS
    labelled = docs.select("doc_id", text_of(text).alias("text")).join(
        F.broadcast(known) if few else known, "doc_id").select("text", (F.col("toxic") > 0).alias("toxic"))
    return (score(docs, train(labelled), text=text)
            .withColumns({"held_out": F.coalesce(out, F.lit(False)),
                          "predicted": (F.col("score") >= threshold).cast("int")})
            .select(*docs.columns, "held_out", "score", "predicted"))
