"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import NO_ID, _powers, batched, cut, mix64, partitions_for, small_batches, text_of

TASK_BYTES = 64 << 20           # of text a task gets at most, about

K, S = 12, 5
DENSITY = (K - S + 1) // 2      # characters an anchor, about
LEAST, TOP = 48, 4              # of a sample: anchors a shorter text keeps at least; one in 2**TOP of a long one


def anchors(texts: list[str], k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Closed syncmers of every text: (text number, code point position, 64-bit hash).

    A k-mer is chosen when the smallest of its inner s-mers is its first or its last one. That
    depends on its own characters alone, so equal passages give equal anchors wherever they
    stand. A text that holds no syncmer (shorter than ``k``, or by chance) has one anchor, at 0,
    for the whole of it; an empty text has none.
    """
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    cp = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(texts)), size)
    up, down = _powers(len(cp) + 1)
    run = np.zeros(len(cp) + 1, np.uint64)
    np.cumsum((cp.astype(np.uint64) + np.uint64(0x51ED270B)) * up[:-1], out=run[1:])
    at = np.zeros(0, np.int64)
    n = len(cp) - k + 1
    if n > 0:
        low = mix64((run[s:] - run[:-s]) * down[:len(run) - s])
        span, first, last = k - s + 1, low[:n], low[k - s:k - s + n]
        least, have = low, 1
        while have < span:                                    # sliding minimum by doubling
            step = min(have, span - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        pick = (least[:n] == first) | (least[:n] == last)
        at = np.flatnonzero(pick)
        at = at[at + k <= end[owner[at]]]
    who = owner[at]
    code = mix64((run[at + k] - run[at]) * down[at] + np.uint64(k))
    bare = np.flatnonzero((np.bincount(who, minlength=len(texts)) == 0) & (size > 0))
    if len(bare):
        lo = (end - size)[bare]
        whole = mix64((run[end[bare]] - run[lo]) * down[lo] + size[bare].astype(np.uint64))
        who = np.concatenate([who, bare])
        at = np.concatenate([at, lo])
        code = np.concatenate([code, whole])
    return who, at - (end - size)[who], code


def sketches(texts: list[str]) -> list[np.ndarray]:
    """Fingerprint of each text, as 32-bit numbers: a 64-bit digest of all anchors and their
    places, the level, then the hashes of the text's sample by place and the gaps between them.

    The digest covers every anchor, so texts that differ in one differ in the fingerprint. The
    sample holds the anchors whose hash begins with as many zero bits as the level: all of them
    in short texts, one in 2**level in longer ones, where the level keeps about ``LEAST`` to twice
    as many and stops at ``TOP``; from there on the sample grows with the text. Whether an anchor
    is in it depends on its own characters alone, so shared passages have shared samples. The
    empty text has an empty fingerprint.
    """
    who, at, code = anchors(texts)
    order = np.lexsort((at, who))
    who, at, code = who[order], at[order], code[order]
    size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    level = np.clip(np.floor(np.log2(np.maximum(size, 1) / (DENSITY * LEAST))), 0, TOP).astype(np.uint32)
    first = np.searchsorted(who, np.arange(len(texts) + 1))
    mixed = mix64(code + mix64(at.astype(np.uint64) + np.uint64(1)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mixed, dtype=np.uint64)])
    top = (code >> np.uint64(32)).astype(np.uint32)
    keep = top.astype(np.uint64) < (np.uint64(1) << (np.uint64(32) - level[who].astype(np.uint64)))
    out = []
    for i, (a, b) in enumerate(zip(first.tolist(), first[1:].tolist())):
        if a == b:
            out.append(np.zeros(0, np.uint32))
            continue
        whole = int(total[b]) - int(total[a]) & (1 << 64) - 1
        k = keep[a:b]
        gaps = np.diff(at[a:b][k], prepend=0)
        wide = bool(len(gaps)) and int(gaps.max()) >> 16 > 0
        if wide:
            packed = gaps.astype("<u4")
        else:
            packed = np.pad(gaps.astype("<u2"), (0, len(gaps) % 2)).view("<u4")
        head = np.array([whole & 0xFFFFFFFF, whole >> 32, int(level[i]) | wide << 8], np.uint32)
        out.append(np.concatenate([head, top[a:b][k], packed]))
    return out


def sample(a: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of a fingerprint's sample; at a higher level than its own, of that level's.
    Two gaps stand in a number, unless one is wider than 16 bits."""
    wide, level = int(a[2]) >> 8, max(level, int(a[2]) & 255)
    n = (len(a) - 3) // 2 if wide else (len(a) - 3) * 2 // 3
    gaps = a[3 + n:] if wide else np.ascontiguousarray(a[3 + n:]).view("<u2")[:n]
    code, at = a[3:3 + n], np.cumsum(gaps.astype(np.int64))
    k = code.astype(np.uint64) < np.uint64(1 << 32 - level)
    return code[k], at[k]


def _pairs(code_a: np.ndarray, code_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of equal hashes, the first with the first, the second with the second
    and so on: as many pairs as both lists hold, never all combinations."""
    def numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(code, kind="stable")
        s = code[order]
        start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        rank = np.arange(len(s)) - np.repeat(start, np.diff(np.concatenate([start, [len(s)]])))
        return order, np.rec.fromarrays([s.astype(np.uint64), rank.astype(np.uint64)])

    oa, ka = numbered(code_a)
    ob, kb = numbered(code_b)
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    return oa[ia], ob[ib]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both samples (at the higher of both levels) that match by position:
    equal hashes on a diagonal, that is at a distance of their places, that at least two pairs
    have; of samples below four anchors every pair counts. 1 for equal fingerprints, 0 when
    only one is empty or nothing matches."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    level = max(int(a[2]) & 255, int(b[2]) & 255)
    code_a, at_a = sample(a, level)
    code_b, at_b = sample(b, level)
    if not len(code_a) or not len(code_b):
        return 0.0
    ia, ib = _pairs(code_a, code_b)
    _, many = np.unique(at_a[ia] - at_b[ib], return_counts=True)
    matched = int(many[many > 1].sum()) if min(len(code_a), len(code_b)) > 3 else int(many.sum())
    # Samples can be alike where the digests, of all anchors, are not.
    return min(matched / (len(code_a) + len(code_b) - matched), 1 - 1e-9)


def shared_passages(x: str, y: str, least: int = 2, k: int = K) -> list[tuple[int, int, int]]:
    """(place in ``x``, place in ``y``, characters) of passages that both texts hold, from runs of
    at least ``least`` matching anchors, each starting within ``k`` of the one before on one diagonal."""
    who, at, code = anchors([x, y])
    a, b = who == 0, who == 1
    ia, ib = _pairs(code[a], code[b])
    pa, pb = at[a][ia], at[b][ib]
    order = np.lexsort((pa, pa - pb))
    pa, pb = pa[order], pb[order]
    if not len(pa):
        return []
    new = np.concatenate([[True], (np.diff(pa - pb) != 0) | (np.diff(pa) > k)])
    begin = np.flatnonzero(new)
    end = np.concatenate([begin[1:], [len(pa)]]) - 1
    return sorted((int(pa[i]), int(pb[i]), int(pa[j] - pa[i]) + min(k, len(x), len(y)))
                  for i, j in zip(begin, end) if j - i + 1 >= least)


ROWS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()),
    # Both fingerprints in one value: they share the kept half's anchors, which then compress.
    T.StructField("prints", T.BinaryType()),
    T.StructField("own", T.IntegerType()),              # bytes of the first of them
    T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()),
])
EDGES = T.StructType([*ROWS.fields, T.StructField("part", T.IntegerType()),
                      T.StructField("head", T.StringType()), T.StructField("tail", T.StringType())])


def _edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(text: str, sketch: np.ndarray, edited: str, edited_sketch: np.ndarray,
         following: np.ndarray) -> tuple:
    return (len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            sketch.tobytes() + edited_sketch.tobytes(), sketch.nbytes, likeness(sketch, edited_sketch),
            likeness(sketch, following))


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents in descending order: each is finished when the one after it is seen. The first
    row carries its text as ``head``, the last as ``tail``, for the partitions on either side."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    held: tuple | None = None                     # id, text, sketch of the row still open
    head: str | None = None
    for pdf in frames:
        ids, all_texts = pdf["doc_id"].tolist(), pdf["text"].tolist()
        for lo, hi in batched(all_texts):
            texts = all_texts[lo:hi]
            own = list(zip(ids[lo:hi], texts, sketches(texts)))
            if held is None:
                head = texts[0]
                chain = own
            else:
                chain = [held, *own]
            edited = [_edit(a[1], b[1]) for a, b in zip(chain, chain[1:])]
            rows = [(a[0], *_row(a[1], a[2], e, es, b[2]), part, None, None)
                    for a, b, e, es in zip(chain, chain[1:], edited, sketches(edited))]
            if rows and head is not None:
                rows[0] = (*rows[0][:-2], head, None)
                head = None
            held = chain[-1]
            if rows:
                yield pd.DataFrame(rows, columns=EDGES.names)
    if held is not None:
        doc, text, sketch = held
        yield pd.DataFrame([(doc, len(text), None, sketch.tobytes(), sketch.nbytes, None, None, part, head,
                             text)], columns=EDGES.names)


def _close(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        rows = []
        for doc, text, sketch, after, after_sketch in zip(
                pdf["doc_id"], pdf["tail"], pdf["first"], pdf["after"],
                pdf["after_sketch"]):
            edited = _edit(text, after)
            rows.append((doc, *_row(text, np.frombuffer(sketch, np.uint32), edited,
                                    sketches([edited])[0], np.frombuffer(after_sketch, np.uint32))))
        yield pd.DataFrame(rows, columns=ROWS.names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text (the second half replaced by the
    beginning of the next document, descending by id; the last one's next is the first) and how
    like its fingerprint is to the edited text's and to the next document's (see :func:`sketches`
    and :func:`likeness`).

    One shuffle deals the texts out by ranges of (id, hash of the text) and sorts them; a task then streams
    its rows and holds one open document. Neighbours in different tasks meet through one head
    and one tail row per task. Rows with equal ids are ordered by their texts' hashes, null ids come
    last, a null text is the empty text (empty sketch, 0 characters). A single row is its own
    next one. No rows, no result. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    small_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    n = partitions_for(size, TASK_BYTES, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    down = F.col("doc_id").desc()
    dealt = (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                         text_of().alias("text"))
             .repartitionByRange(n, down, F.xxhash64("text"))
             .sortWithinPartitions(down, F.xxhash64("text"), "text"))
    rows = cut(dealt.mapInPandas(_walk, EDGES), "fingerprints")
    first = F.expr("substring(prints, 1, own)")
    heads = rows.where("head is not null").select(
        F.col("part").alias("next_part"), F.col("head").alias("after"), first.alias("after_sketch"))
    # One row per task that had documents.
    order = Window.orderBy("next_part")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = heads.select(
        F.col("next_part").alias("part"),
        F.coalesce(F.lead("next_part").over(order),
                   F.first("next_part").over(everything)).alias("next_part"))
    tails = (rows.where("tail is not null").select("doc_id", first.alias("first"), "tail", "part")
             .join(follows, "part").join(heads, "next_part"))
    done = rows.where("tail is null").select(*ROWS.names).unionByName(tails.mapInPandas(_close, ROWS))
    done = done.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
    text = lambda c: F.translate(F.base64(c), "\r\n", "")
    return done.select("doc_id", "n_chars", "edited_sha256", text(first).alias("fingerprint"),
                       text(F.expr("substring(prints, own + 1)")).alias("edited_fingerprint"), "near_edited", "near_next")
