"""Similarity self-join of documents on word shingles by T-occurrence search.

Two documents link when their shingle sets' Jaccard similarity reaches a threshold, which means
an overlap of at least T shingles, T depending on the two set sizes. Seen as a query against
inverted lists, DivideSkip sets the T - 1 longest of a document's lists aside: whatever reaches T
must occur in one of the other, short lists. Those are merged, and each document found there is
checked against the long lists by binary probes.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import (batched, cut, joined_bytes, mix64, partitions_for, small_batches,
                                 span_hashes, text_of, words_of)

# Ids of at most this many documents may be broadcast (16 MB); beyond it they are joined by shuffle.
BROADCAST_IDS = 2_000_000
# Least number of buckets the counting prefixes are dealt into.
BUCKETS = 128
# Shares of a document's shingles: the extra length of the counting prefix.
SLACK = 15


def _place(i: int) -> np.uint64:
    """An odd multiplier for each place in a shingle."""
    return mix64(np.full(1, i + 1, np.uint64) * np.uint64(0xD1B54A32D192ED03))[0] | np.uint64(1)


def shingle_sets(texts: list[str], n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles of each text, A-Z as a-z. Fewer
    than ``n`` words make one shingle of all of them; no word, none."""
    buf, at = joined_bytes(texts)
    start, stop = words_of(buf)
    h = span_hashes(buf, start, stop, fold=True)
    cuts = np.searchsorted(start, at)
    full = max(len(h) - n + 1, 0)
    roll = np.zeros(full, np.uint64)
    for i in range(n if full else 0):
        roll += h[i:i + full] * _place(i)
    roll = mix64(roll)
    out = []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(roll[a:b - n + 1]))
        elif b > a:
            z = np.full(1, b - a, np.uint64)
            for i in range(b - a):
                z = z + h[a + i:a + i + 1] * _place(i)
            out.append(mix64(z))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _up(a, b: int):
    return -(-a // b)


# --- what every document yields -------------------------------------------------------------

SIZES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("sig", T.BinaryType())])
POSTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("codes", T.BinaryType()),
                      T.StructField("docs", T.BinaryType())])
COUNTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shared", T.LongType())])
SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                     T.StructField("s", T.ArrayType(T.LongType(), False)),
                     T.StructField("sig", T.BinaryType())])


def _each(frames: Iterator[pd.DataFrame], n: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    for pdf in frames:
        texts, ids = pdf["text"].tolist(), pdf["doc_id"].to_numpy(np.int64)
        for lo, hi in batched(texts):
            yield ids[lo:hi], shingle_sets(texts[lo:hi], n)


def _sig(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sizes(n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, sets in _each(frames, n):
            yield pd.DataFrame({"doc_id": ids, "n": [len(s) for s in sets], "sig": [_sig(s) for s in sets]})
    return run


def _posts(n: int, percent: int, buckets: int, flush: int = 500_000):
    """Counting prefixes of many documents at a time, as one row per bucket of codes. A code held
    by two documents of this task is counted here and travels once, without a document."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        held = 0

        def emit() -> Iterator[pd.DataFrame]:
            nonlocal codes, docs, held
            c, d = np.concatenate(codes), np.concatenate(docs)
            order = np.argsort(c, kind="stable")
            c, d = c[order], d[order]
            new = np.concatenate([[True], c[1:] != c[:-1]])
            alone = new & np.concatenate([new[1:], [True]])
            here = d[~alone]
            d = np.where(alone, d, np.iinfo(np.int64).min)
            if len(here):
                ids, n_shared = np.unique(here, return_counts=True)
                yield pd.DataFrame({"bucket": [-1], "codes": [n_shared.astype(np.int64).tobytes()],
                                    "docs": [ids.tobytes()]})
            c, d = c[new], d[new]
            b = (c >> np.uint64(32)).astype(np.int64) * buckets >> 32
            cuts = np.searchsorted(b, np.arange(buckets + 1))
            low = (c * np.uint64(buckets)).astype(np.uint64) >> np.uint64(32)
            low = low.astype(np.uint32)
            for i in range(buckets):
                if cuts[i + 1] > cuts[i]:
                    p = slice(cuts[i], cuts[i + 1])
                    yield pd.DataFrame({"bucket": [i], "codes": [low[p].tobytes()],
                                        "docs": [d[p].tobytes()]})
            codes, docs, held = [], [], 0

        for ids, sets in _each(frames, n):
            for i, s in zip(ids, sets):
                if len(s):
                    k = len(s)
                    p = s[:k - _up(percent * k, 100) + _up(SLACK * k, 100)]
                    codes.append(p)
                    docs.append(np.full(len(p), i))
                    held += len(p)
            if held >= flush:
                yield from emit()
        if held:
            yield from emit()
    return run


def _count_shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per document, how many of its codes in this bucket another document has too."""
    if pdf["bucket"].iloc[0] < 0:
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["docs"]])
        n = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["codes"]])
    else:
        c = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["codes"]])
        d = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["docs"]])
        order = np.argsort(c, kind="stable")
        c, d = c[order], d[order]
        new = np.concatenate([[True], c[1:] != c[:-1]])
        alone = new & np.concatenate([new[1:], [True]])
        many = d == np.iinfo(np.int64).min
        ids, n = np.unique(d[~alone & ~many], return_counts=True)
    return pd.DataFrame({"doc_id": ids, "n_shared": n.astype(np.int64)})


def _sets(n: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, sets in _each(frames, n):
            yield pd.DataFrame({"doc_id": ids, "n": [len(s) for s in sets],
                                "s": [s.view(np.int64) for s in sets], "sig": [_sig(s) for s in sets]})
    return run


# --- candidates and checks ------------------------------------------------------------------

def _may_link(percent: int, nx: Column, px: Column, ny: Column, py: Column) -> Column:
    """Sizes and places in the two prefixes leave room for the required overlap."""
    need = F.ceil((nx + ny) * F.lit(percent) / F.lit(100 + percent))
    return ((100 * F.least(nx, ny) >= percent * F.greatest(nx, ny))
            & (F.least(nx - px, ny - py) >= need - 1e-9))


def divide_skip(query: np.ndarray, candidates: list[np.ndarray], percent: int) -> list[bool]:
    """Which candidates reach the overlap the query needs with them.

    All arrays are sorted and distinct. A candidate's shingles are probed by binary search; after
    each of a few slices the probe stops when the misses so far rule the overlap out.
    """
    out = []
    for c in candidates:
        a, b = (query, c) if len(query) <= len(c) else (c, query)
        need = _up((len(a) + len(b)) * percent, 100 + percent)
        hits, done = 0, 0
        for part in np.array_split(a, 4 if len(a) >= 64 else 1):
            at = np.searchsorted(b, part)
            hits += int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == part))
            done += len(part)
            if hits + len(a) - done < need:
                break
        out.append(100 * hits >= percent * (len(a) + len(b) - hits))
    return out


LINKS = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])


def _check(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = {d: np.asarray(s, np.int64).view(np.uint64) for d, s in zip(pdf["doc_id"], pdf["s"])}
        head = int(pdf["x"].iloc[0])
        others = [d for d in sets if d != head]
        ok = divide_skip(sets[head], [sets[d] for d in others], percent)
        return pd.DataFrame({"x": [head] * sum(ok), "y": [d for d, o in zip(others, ok) if o]},
                            columns=["x", "y"]).astype("int64")
    return run


def _only(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose doc_id is in ``ids``: by broadcast while ids are few, else by shuffle."""
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, per_task: int = 2000) -> DataFrame:
    """The pairs (x, y) that link. A head document meets its partners in groups of about
    ``per_task``: a head with more of them has several groups, each with a copy of its set."""
    groups = (pairs.groupBy("x").agg(F.count(F.lit(1)).alias("m"))
              .withColumn("parts", F.ceil(F.col("m") / per_task).cast("int")))
    dealt = pairs.join(groups, "x").select(
        "x", F.pmod(F.xxhash64("y"), F.col("parts")).cast("int").alias("part"),
        F.col("y").alias("doc_id"))
    heads = dealt.select("x", "part", F.col("x").alias("doc_id")).distinct()
    members = cut(dealt.unionByName(heads), "join-members")
    needed = _only(sets.select("doc_id", "s"), members.select("doc_id").distinct())
    links = (members.join(needed, "doc_id").groupBy("x", "part")
             .applyInPandas(_check(percent), LINKS))
    return cut(links, "join-links")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, component_id): the smallest id reachable from each node over ``links`` (x, y).

    Every round takes the smallest label among a node and its neighbours, then the label's own
    label, so labels travel twice as far each round. Only nodes and links are shuffled, and each
    round's labels are written out.
    """
    spark = nodes.sparkSession
    both = cut(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
               .where("x <> y").distinct(), "join-edges")
    linked = both.select(F.col("x").alias("doc_id")).distinct()
    labels = cut(linked.withColumn("label", F.col("doc_id")), "join-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("doc_id", "y"), "y")
                .groupBy(F.col("x").alias("doc_id")).agg(F.min("label").alias("near")))
        least = labels.join(near, "doc_id").select(
            "doc_id", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("doc_id").alias("label"), F.col("label").alias("further"))
        new = cut(least.join(jump, "label").select(
            "doc_id", "was", F.least("label", "further").alias("label")), "join-labels")
        labels = new.select("doc_id", "label")
        if new.where("label <> was").isEmpty():
            break
    return nodes.select("doc_id").join(labels, "doc_id", "left").select(
        "doc_id", F.coalesce("label", "doc_id").alias("component_id"))


def _release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that were cut off."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def jaccard_components(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles and component_id, where documents link when
    100 * intersection >= percent * union of their ``n``-word shingle sets.

    1. Documents with equal sets form a class; its smallest id stands for it.
    2. Pruning. With shingles in hash order, two documents that overlap in T shingles share at
       least k of their first n - T + k. Prefixes are rounded up and the count asked for is rounded
       down, so what a smaller partner's shorter prefix holds is enough. A document that shares
       fewer with any other has no partner. The shared codes are counted over all documents; a code
       is reduced map-side, so a frequent one travels once per task.
    3. T-occurrence search among the rest. Lists are ordered by their true length; a document's
       prefix holds its short lists. Sizes and places in the lists rule pairs out. First every
       document of a list is paired with the list's pivot (the one with the fewest rare
       shingles); after that only documents of one list that are still in different components
       are paired, and never two documents already connected.
    4. Each pair's overlap is settled by binary probes of the sets (:func:`divide_skip`), and the
       links give components.

    Nothing is capped: a frequent shingle or a large group only changes which pairs need a look.
    A group whose members are alike settles in the pivot round, in proportion to its size.

    Rows with a null id are left out of the search and returned with null component_id and 0
    shingles; rows that repeat an id are taken as one document with one of their texts (the one
    with the smallest digest) and each returned. A null or empty text has no shingles and is its own component. Other columns are
    ignored. No rows, no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sizes = cut(rows.where("doc_id is not null").mapInPandas(_sizes(n), SIZES), "join-sizes")
    one = cut(sizes.groupBy("doc_id").agg(F.min(F.struct("sig", "n")).alias("v"))
              .select("doc_id", "v.n", "v.sig"), "join-docs")
    classes = one.where("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("head"))
    heads = cut(classes, "join-classes")

    # 2. pruning
    total = one.agg(F.sum("n")).first()[0] or 0
    # A document's shared codes spread over the buckets and come back as one row from each. With
    # BUCKETS at least, that is about a row per shared code at any size of the corpus.
    buckets = min(1 << 16, partitions_for(total * (100 - percent + SLACK) / 100, 1_000_000, BUCKETS))
    posts = rows.where("doc_id is not null").mapInPandas(_posts(n, percent, buckets), POSTS)
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("docs"), F.lit(buckets))) \
        .otherwise(F.col("bucket")).cast("int")
    shared = (posts.withColumn("bucket", spread).groupBy("bucket")
              .applyInPandas(_count_shared, COUNTS)
              .groupBy("doc_id").agg(F.sum("n_shared").alias("n_shared")))
    live = cut(heads.withColumnRenamed("head", "doc_id").join(shared, "doc_id")
               .where(F.col("n_shared") >= F.greatest(F.lit(1), F.floor(F.col("n") * min(SLACK, percent) / 100)))
               .select("doc_id", "sig"),
               "join-live")
    _release(spark)

    # 3. short lists of the documents left
    ids = live.select("doc_id")
    sets = _only(rows, ids).mapInPandas(_sets(n), SETS)
    again = one.count() < sizes.count()
    if again:                       # of the rows that repeat an id, one with the text that counts
        sets = sets.join(live, ["doc_id", "sig"], "left_semi").dropDuplicates(["doc_id"])
    sets = cut(sets.drop("sig"), "join-sets")
    posted = sets.select("doc_id", "n", F.explode("s").alias("h"))
    lists = posted.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (posted.join(lists, "h").groupBy("doc_id", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("l")))
    short = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    rare = F.col("n") - F.size("l")
    short_lists = cut(
        ranked.select("doc_id", "n", rare.alias("rare"),
                      F.posexplode(F.slice("l", F.lit(1), F.greatest(short - rare, F.lit(0)).cast("int")))
                      .alias("i", "e"))
        .select("doc_id", "n", (F.col("rare") + F.col("i")).alias("p"), F.col("e.h").alias("h")),
        "join-lists")
    _release(spark)

    pivot = short_lists.groupBy("h").agg(F.min(F.struct("p", "doc_id", "n")).alias("v"))
    stars = (short_lists.join(pivot, "h").where("doc_id <> v.doc_id")
             .where(_may_link(percent, F.col("n"), F.col("p"), F.col("v.n"), F.col("v.p")))
             .select(F.col("v.doc_id").alias("x"), F.col("doc_id").alias("y")).distinct())
    first = _verified(stars, sets, percent)
    near = components(ids, first)
    _release(spark)

    # Lists that still join different components: each document outside the list's largest
    # component meets the documents of the list in other components than its own.
    held = cut(short_lists.join(near, "doc_id"), "join-held")
    by_comp = held.groupBy("h", "component_id").agg(F.count(F.lit(1)).alias("m"))
    main = (by_comp.groupBy("h").agg(F.max(F.struct("m", "component_id")).alias("v"),
                                     F.count(F.lit(1)).alias("comps"))
            .where("comps > 1").select("h", F.col("v.component_id").alias("main")))
    open_ = held.join(main, "h")
    a = open_.where("component_id <> main").select(
        "h", *[F.col(c).alias(f"a_{c}") for c in ("doc_id", "n", "p", "component_id")])
    rest = (a.join(open_, "h").where("a_component_id <> component_id")
            .where((F.col("component_id") == F.col("main")) | (F.col("a_doc_id") < F.col("doc_id")))
            .where(_may_link(percent, F.col("a_n"), F.col("a_p"), F.col("n"), F.col("p")))
            .select(F.least("a_doc_id", "doc_id").alias("x"), F.greatest("a_doc_id", "doc_id").alias("y"))
            .distinct())
    second = _verified(rest, sets, percent)
    found = components(ids, first.unionByName(second))

    # 4. back to all documents: a class takes its head's component. A component's id is its
    # smallest document, and the smallest of a class is its head.
    of_class = heads.join(found.withColumnRenamed("doc_id", "head"), "head", "left").select(
        "sig", "n", F.coalesce("component_id", "head").alias("component_id"))
    done = one.join(of_class, ["sig", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    nulls = rows.where("doc_id is null")
    if again or not nulls.isEmpty():
        done = rows.select("doc_id").join(done, "doc_id", "left").withColumn(
            "n_shingles", F.coalesce("n_shingles", F.lit(0)))
    return done
