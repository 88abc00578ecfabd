"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import batched, cut, small_batches, text_of

ORDER = 4                       # characters of a gram, 16 bits each in one 64-bit code
BITS = 16
START, END, AGAIN = "\x01", "\x02", "\x03"
PAIR = (1 << (2 * BITS)) - 1    # the last two signs of a gram
PHRASE = 4                      # words of the longest phrase whose repetition is marked
# Tables of at most this many grams (48 MB) may be sent to every task; beyond it they are joined.
BROADCAST_GRAMS = 4_000_000
BROADCAST_IDS = 2_000_000
COUNTS = T.StructType([T.StructField("gram", T.LongType()), T.StructField("c", T.LongType())])


def fold(texts: list[str]) -> list[str]:
    """Texts with white space folded, and every word that repeats a phrase written as one sign.

    A word is such a repetition when for some p up to ``PHRASE`` the p words that end with it equal
    the p words before them. It becomes ``AGAIN`` without a space before it, so that a document of
    one repeated word or phrase is a run of signs, which running text hardly has, and not a string
    of well-formed words, whose characters a model of characters finds quite likely.
    """
    words = [t.split() for t in texts]
    flat = [w for ws in words for w in ws]
    if not flat:
        return [""] * len(texts)
    code = pd.factorize(np.array(flat, dtype=object))[0]
    n = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), n)
    again = np.zeros(len(flat), bool)
    for p in range(1, PHRASE + 1):
        same = np.zeros(len(flat) + 1, np.int64)
        same[p + 1:] = (code[p:] == code[:-p]) & (owner[p:] == owner[:-p])
        upto = np.cumsum(same)
        again[p - 1:] |= upto[p:] - upto[:-p] == p
    out, end = [], np.cumsum(n)
    touched = np.add.reduceat(np.append(again, False), np.minimum(end - n, len(flat))) > 0
    for i, ws in enumerate(words):
        if n[i] and touched[i]:
            marks = again[end[i] - n[i]:end[i]].tolist()
            out.append("".join([AGAIN if a else " " + w for a, w in zip(marks, ws)])[1:])
        else:
            out.append(" ".join(ws))
    return out


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all grams, text after text, and the number of grams of each text. Texts are folded
    (:func:`fold`); one of n characters then has n + 1 grams, the last one for its end. Code points
    beyond 16 bits count modulo 2**16."""
    folded = fold(texts)
    size = np.fromiter((len(t) + 1 for t in folded), np.int64, len(folded))
    pad = START * (ORDER - 1)
    raw = "".join([x for t in folded for x in (pad, t, END)])
    cp = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) \
        & np.uint64((1 << BITS) - 1)
    if not len(cp):
        return np.zeros(0, np.int64), size
    code = cp[ORDER - 1:].copy()
    for j in range(1, ORDER):
        code |= cp[ORDER - 1 - j:len(cp) - j] << np.uint64(BITS * j)
    keep = np.ones(len(cp), bool)
    begin = np.cumsum(size + ORDER - 1) - size - ORDER + 1
    for j in range(ORDER - 1):
        keep[begin + j] = False
    return code[keep[ORDER - 1:]].view(np.int64), size


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Gram counts of a task: trusted texts count, the grams of others come with count 0. A second
    repetition in a row is never learned: a few mislabelled texts of one word hold thousands."""
    codes: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def merged() -> pd.DataFrame:
        code, uniq = pd.factorize(np.concatenate(codes))
        return pd.DataFrame({"gram": uniq, "c": np.bincount(code, np.concatenate(counts), len(uniq)).astype(np.int64)})

    for pdf in frames:
        texts, good = pdf["text"].tolist(), pdf["trusted"].to_numpy(bool)
        for lo, hi in batched(texts):
            g, size = grams(texts[lo:hi])
            code, uniq = pd.factorize(g)
            codes.append(uniq)
            learn = np.repeat(good[lo:hi], size) & ((g & PAIR) != (ord(AGAIN) << BITS | ord(AGAIN)))
            counts.append(np.bincount(code, learn, len(uniq)))
            if sum(map(len, codes)) > 500_000:
                m = merged()
                codes, counts = [m["gram"].to_numpy()], [m["c"].to_numpy()]
                if len(m) > 400_000:
                    yield m
                    codes, counts = [], []
    if codes:
        yield merged()


def _suffix(c: str, k: int) -> Column:
    return F.col(c).bitwiseAND(F.lit((1 << (BITS * k)) - 1))


def _context(c: str) -> Column:
    return F.shiftrightunsigned(c, BITS)


def log_probabilities(counts: DataFrame) -> DataFrame:
    """(gram, lp): log probability of each gram's last character after its first ones, for all
    grams in ``counts`` (gram, c), counted or not.

    Orders below the highest count the distinct grams that end in theirs. Each order has three
    discounts from its counts of counts; the mass they free goes to the order below, down to a
    uniform one. A context never seen passes everything down. Every step is a join or a grouping
    on gram codes, so tables stay sharded at any size; only four numbers an order reach the driver.
    """
    order = {ORDER: cut(counts.where("c > 0"), "kn-counts")}
    asked = {ORDER: counts.select("gram")}
    for k in range(ORDER - 1, 0, -1):
        order[k] = cut(order[k + 1].groupBy(_suffix("gram", k).alias("gram"))
                       .agg(F.count(F.lit(1)).alias("c")), "kn-counts")
        asked[k] = asked[k + 1].select(_suffix("gram", k).alias("gram")).distinct()
    letters = order[1].count()
    lower: DataFrame | None = None
    for k in range(1, ORDER + 1):
        r = order[k].agg(*[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
        n1, n2, n3, n4 = (max(1, r[f"n{i}"]) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        d = [min(max(v, 0.0), i + 0.0) for i, v in
             ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
        c = F.coalesce(F.col("c"), F.lit(0))
        discount = F.when(c >= 3, d[2]).when(c == 2, d[1]).when(c == 1, d[0]).otherwise(0.0)
        contexts = order[k].groupBy(_context("gram").alias("context")).agg(
            F.sum("c").alias("total"), F.sum(discount).alias("freed"))
        t = (asked[k].join(order[k], "gram", "left").withColumn("context", _context("gram"))
             .join(contexts, "context", "left"))
        if lower is None:
            below = F.lit(1.0 / (letters + 1))
        else:
            t = t.withColumn("low", _suffix("gram", k - 1)).join(
                lower.select(F.col("gram").alias("low"), F.col("p").alias("below")), "low")
            below = F.col("below")
        p = F.when(F.col("total").isNull(), below).otherwise(
            (F.greatest(c - discount, F.lit(0.0)) + F.col("freed") * below) / F.col("total"))
        lower = cut(t.select("gram", F.greatest(p, F.lit(1e-12)).alias("p")), "kn-probabilities")
    return lower.select("gram", F.log("p").alias("lp"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents whose labels all say good quality and not toxic."""
    return labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")).where(
        "q = 1 and t = 0").select("doc_id")


def _mark(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    ids = trusted.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_trusted"))
    few = ids.count() <= BROADCAST_IDS
    return (docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == F.col("_id"), "left")
            .drop("_id").withColumn("_trusted", F.coalesce("_trusted", F.lit(False))))


def _with_scores(docs: DataFrame, table: DataFrame, text: str) -> DataFrame:
    """``docs`` with _nll, the negative log probability of the whole text, and _n, its grams."""
    spark = docs.sparkSession
    if table.count() <= BROADCAST_GRAMS:
        got = table.orderBy("gram").toArrow()
        model = spark.sparkContext.broadcast((got["gram"].to_numpy(), got["lp"].to_numpy()))
        schema = T.StructType([*docs.schema.fields, T.StructField("_nll", T.DoubleType()),
                               T.StructField("_n", T.LongType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, lp = model.value
            for b in batches:
                texts = [t or "" for t in b.column(text).to_pylist()]
                nll, n = [np.zeros(0)], [np.zeros(0, np.int64)]
                for lo, hi in batched(texts):
                    g, size = grams(texts[lo:hi])
                    code, uniq = pd.factorize(g)
                    values = lp[np.searchsorted(keys, uniq)][code]
                    owner = np.repeat(np.arange(len(size)), size)
                    nll.append(-np.bincount(owner, values, len(size)))
                    n.append(size)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(np.concatenate(nll)), pa.array(np.concatenate(n))],
                    [*b.schema.names, "_nll", "_n"])

        return docs.mapInArrow(run, schema)

    def counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for key, t in zip(pdf["digest"], pdf["text"]):
                g, n = np.unique(grams([t])[0], return_counts=True)
                yield pd.DataFrame({"digest": key, "gram": g, "n": n})

    digest = F.sha2(text_of(text), 256)
    texts = docs.select(digest.alias("digest"), text_of(text).alias("text")).dropDuplicates(["digest"])
    scores = (texts.mapInPandas(counts, "digest string, gram long, n long").join(table, "gram")
              .groupBy("digest").agg(F.sum(-F.col("n") * F.col("lp")).alias("_nll"), F.sum("n").alias("_n")))
    return (docs.withColumn("_digest", digest)
            .join(scores.withColumnRenamed("digest", "_digest"), "_digest").drop("_digest"))


def classify(docs: DataFrame, labels: DataFrame, *, text: str = "text", quantile: float = 0.95,
             margin: float = 1.35, steady: int = 100, hold_out: int = 4) -> DataFrame:
    """``docs`` with ``perplexity``, ``threshold`` and ``accepted``.

    One trusted document in ``hold_out`` (by a hash of its id, see :func:`trusted_ids`) is kept
    from the model, which counts the characters of all others and so grows with them; 0 keeps
    none. A language's threshold is ``margin`` times the ``quantile`` of its held-out documents'
    perplexities, which texts the model has not seen can be measured by; a language without
    any takes the quantile of all of them; the quantile leaves room for mislabelled documents and
    the margin for the clean ones above it. Thresholds come from held-out documents only: without any,
    or without a trusted document to count, nothing can be judged, and all documents are accepted,
    with null perplexity and threshold. With ``hold_out`` 0 the caller chooses to measure the
    trusted documents that were counted. Short texts say little: every text is scored as if ``steady`` more characters of the
    trusted mean followed.

    Two scans of the texts (counts, scores) and one of the trusted ones (thresholds); texts are
    not shuffled while the probability table is small enough to send along, see
    ``BROADCAST_GRAMS``; a larger one is joined by gram with the same result. Null texts are
    empty texts and accepted.
    A null language is a language. Repeated rows get equal results. Existing columns of these three names
    are replaced; all others stay. No rows, no result.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("perplexity", "threshold", "accepted")
    marked = _mark(docs, trusted_ids(labels))
    nothing = docs.withColumns({"perplexity": F.lit(None).cast("double"),
                                "threshold": F.lit(None).cast("double"), "accepted": F.lit(True)})
    held = F.pmod(F.xxhash64("doc_id"), F.lit(hold_out)) == 0 if hold_out else F.lit(False)
    counts = cut(marked.select(text_of(text).alias("text"), (F.col("_trusted") & ~held).alias("trusted"))
                 .mapInPandas(_count, COUNTS).groupBy("gram").agg(F.sum("c").alias("c")), "kn-grams")
    if counts.where("c > 0").isEmpty():
        return nothing
    table = cut(log_probabilities(counts), "kn-table")
    lang = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")) if "lang" in docs.columns else F.lit("")
    measured = F.col("_trusted") & held if hold_out else F.col("_trusted")
    good = cut(_with_scores(marked.where(measured).select(lang.alias("_lang"), F.col(text).alias(text)),
                            table, text).drop(text), "kn-trusted")
    if good.isEmpty():
        return nothing
    mean = good.agg((F.sum("_nll") / F.sum("_n")).alias("m")).first()["m"]
    ppl = F.exp((F.col("_nll") + steady * mean) / (F.col("_n") + steady))
    at = F.percentile_approx(ppl, F.lit(quantile), F.lit(10_000)) * margin
    overall = good.agg(at.alias("t")).first()["t"]
    # One row per language.
    by_lang = F.broadcast(good.groupBy("_lang").agg(at.alias("threshold")))
    scored = _with_scores(docs.withColumn("_lang", lang), table, text)
    return (scored.join(by_lang, "_lang", "left")
            .withColumns({"perplexity": ppl, "threshold": F.coalesce("threshold", F.lit(overall))})
            .withColumn("accepted", (F.length(text_of(text)) == 0) | (F.col("perplexity") <= F.col("threshold")))
            .select(*docs.columns, "perplexity", "threshold", "accepted"))
