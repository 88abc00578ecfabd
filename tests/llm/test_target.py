"""Vector codes, importance resampling, toxicity."""
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

from snapline.llm import importance, toxicity, vector_codes
from snapline.llm.common import table
from tests.conftest import SF_SMALL


# --- vector codes -----------------------------------------------------------------------

def slow_codes(rows, parts=8, entries=16, rounds=6):
    """(id, label, vector) rows by the definition, in whole numbers."""
    kept = [(i, l, [math.floor(4096 * float(x)) for x in v]) for i, l, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, _, v in kept), default=0) // parts))
    kept = [(i, l, v + [0] * (parts * width - len(v))) for i, l, v in kept]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0]))[:entries]
    books = [[r[2][p * width:(p + 1) * width] for r in order] for p in range(parts)]

    def nearest(p, y):
        return min((sum((a - b) ** 2 for a, b in zip(y, c)), j) for j, c in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            mine = [(nearest(p, v[p * width:(p + 1) * width])[1], v[p * width:(p + 1) * width]) for _, _, v in kept]
            book = []
            for j, c in enumerate(books[p]):
                got = [y for k, y in mine if k == j]
                book.append([sum(col) // len(got) for col in zip(*got)] if got else c)
            new.append(book)
        books = new
    out = []
    for i, l, v in kept:
        found = [nearest(p, v[p * width:(p + 1) * width]) for p in range(parts)]
        out.append((i, l, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    total = {}
    for _, l, _, e in out:
        total[l] = total.get(l, 0) + e
    return sorted(((i, c, e, total[l], digest) for i, l, c, e in out), key=str)


def check_codes(spark, rows):
    df = spark.createDataFrame([(i, l, v, "x") for i, l, v in rows],
                               "vec_id long, label int, embedding array<float>, code string")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]          # as 32-bit floats
    got = sorted((tuple(r) for r in vector_codes.compress(df).collect()), key=str)
    assert got == slow_codes(rows)


def test_vector_codes_match_the_definition(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i) * 3 - 40, int(i) % 3 if i % 7 else None, rng.normal(0, .1, 16).round(2).tolist()) for i in range(150)]
    rows += [(7000, 1, None), (7001, 1, [None] + [0.5] * 15), (-900, 2, [float("nan")] * 16),
             (-901, 2, [float("inf")] + [0.0] * 15), (7002, 0, [0.0] * 16), (7003, 0, [0.0] * 16), (7002, 0, [0.0] * 16)]
    check_codes(spark, rows)


def test_vector_codes_of_few_short_and_no_vectors(spark):
    check_codes(spark, [(5, None, [0.25] * 11), (2, 1, [-0.25] * 3), (9, 1, [])])
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert vector_codes.compress(empty).collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, 1, None)], empty.schema)).collect() == []


def test_vector_codes_hold_huge_components_at_the_limit(spark):
    df = spark.createDataFrame([(1, 1, [1e30] * 8), (2, 1, [-1e30] * 8)], "vec_id long, label int, embedding array<float>")
    assert [r["error"] for r in vector_codes.compress(df).collect()] == [0, 0]


def test_bounds_equal_full_scans_and_skip_most(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (4000, 2, 4)) + rng.choice([-4000, 0, 4000], (4000, 2, 1))
    books = [x[:16].transpose(1, 0, 2).copy()]
    memory = None
    seen = []
    real = vector_codes.Bounds.distances

    def counted(self, rows, part, entry):
        out = real(self, rows, part, entry)
        seen[-1] += out.size
        return out
    monkeypatch.setattr(vector_codes.Bounds, "distances", counted)
    for _ in range(7):
        seen.append(0)
        b = vector_codes.Bounds(np.stack(books))
        memory = b.first(x) if memory is None else b.again(x, *memory)
        d = ((x[:, :, None] - books[-1][None]) ** 2).sum(axis=3)
        assert (memory[0] == d.argmin(axis=2)).all()
        upper = np.sqrt(np.take_along_axis(d, memory[0][:, :, None].astype(int), 2)[:, :, 0])
        today = memory[1] + b.moved[memory[2], np.arange(2), memory[0]]
        assert (today >= upper * (1 - 1e-12)).all()
        new = books[-1].copy()
        for p in range(2):
            for j in range(16):
                if (memory[0][:, p] == j).any():
                    new[p, j] = x[memory[0][:, p] == j, p].sum(axis=0) // (memory[0][:, p] == j).sum()
        books.append(new)
    assert seen[-1] < seen[0] / 3                              # distances looked at


def test_net_displacement_is_never_more_than_the_drifts():
    rng = np.random.default_rng(1)
    history = rng.integers(-50, 50, (6, 2, 5, 3))
    b = vector_codes.Bounds(history)
    step = np.sqrt(((history[1:] - history[:-1]).astype(float) ** 2).sum(axis=3))
    drift = np.concatenate([step[::-1].cumsum(axis=0)[::-1], np.zeros((1, 2, 5))])
    assert (b.moved <= drift * (1 + 1e-8)).all() and (b.moved < drift - 1).any()


# --- importance resampling --------------------------------------------------------------

def test_crc_of_spans_of_any_length():
    rng = np.random.default_rng(2)
    buf = rng.integers(0, 256, 30_000).astype(np.uint8)
    size = np.concatenate([np.arange(1, 400), [1000, 4096, 20_001, 30_000]])
    start = np.array([rng.integers(0, 30_000 - s + 1) for s in size])
    got = importance.crc32_spans(buf, start, start + size)
    assert got.tolist() == [zlib.crc32(buf[a:a + s].tobytes()) for a, s in zip(start, size)]
    assert len(importance.crc32_spans(buf, start[:0], start[:0])) == 0


def slow_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def slow_resample(docs, target, buckets=10_000):
    hashed = [([zlib.crc32(f.encode()) % buckets for f in slow_features(t)[1]], len(slow_features(t)[0])) for _, t in docs]
    s, t = [0] * buckets, [0] * buckets
    for found, _ in hashed:
        for b in found:
            s[b] += 1
    for x in target:
        for f in slow_features(x)[1]:
            t[zlib.crc32(f.encode()) % buckets] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for (i, _), (found, words) in zip(docs, hashed):
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in found) // len(found) if found else 0
        rows.append([i, words, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for k, r in enumerate(able[:25 * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def test_resampling_matches_the_definition(spark):
    docs = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in table(spark, SF_SMALL, "benchmark").collect()] + [None, ""]
    docs += [(9001, None), (9002, ""), (9003, "one"), (None, "word " * 30), (9004, "ÀB cd-ef\x00gh {x} " * 40),
             (9005, "q" * 5000 + " zz " * 25), (9006, "Tie tie, TIE! " * 9), (9006, "Tie tie, TIE! " * 9)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, weight int, rank string")
    got = importance.resample(df, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow_resample(docs, target)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b " * 40)], none.schema)
    assert importance.resample(none, one).collect() == []
    assert len(importance.resample(one, none).collect()) == 1


def test_ranks_cross_range_borders(spark):
    from pyspark.sql import functions as F
    df = spark.range(5000).withColumn("v", F.xxhash64("id") % 50)
    got = importance.ranked(df, [F.col("v").desc(), F.col("id").asc()], "place", rows_a_task=300).collect()
    assert [r["place"] for r in sorted(got, key=lambda r: (-r["v"], r["id"]))] == list(range(1, 5001))


# --- toxicity ---------------------------------------------------------------------------

def test_features_and_ratios_by_hand():
    texts = ["", "  ", "Ab\n ab", "x" * 300, "é"]
    who, what, rate = toxicity.features(texts)
    assert set(who.tolist()) == {2, 3, 4} and (what[who == 4] < 1 << toxicity.BITS).all()
    alone = toxicity.features(["Ab ab"])
    assert what[who == 2].tolist() == alone[1].tolist() and rate[who == 2].tolist() == alone[2].tolist()
    grams = [f" {'ab ab'} "[i:i + n] for n in toxicity.SIZES for i in range(7 - n + 1)]
    assert len(alone[1]) == len(set(grams))
    assert sorted(alone[2]) == pytest.approx(sorted(math.log1p(100 * grams.count(g) / 57) for g in set(grams)))
    import pandas as pd
    r = toxicity.ratios(pd.DataFrame({"feature": [1, 2, 3], "toxic": [9, 0, 1], "clean": [0, 50, 5]}), 10, 90, 1.0, 0.3, 4)
    assert r[1] == pytest.approx(math.log(9.1 / 10) - math.log(0.9 / 90))
    assert r[2] == pytest.approx(math.log(0.1 / 10) - math.log(50.9 / 90)) and r[0] == 0


def made(rng, n, words, mark):
    return [" ".join([*rng.choice(words, 60), *([mark] if mark and rng.random() < .9 else [])]) for _ in range(n)]


def test_toxicity_held_out_and_edges(spark):
    rng = np.random.default_rng(11)
    words = np.array(["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)])
    texts = made(rng, 400, words, None) + made(rng, 60, words, "zqvile")
    rows = [(i, t, 5, "s") for i, t in enumerate(texts)]
    rows += [(9001, None, 0, "s"), (9002, "", 0, "s"), (9003, (texts[0] + " ") * 200, 0, "s"), (None, texts[-1], 0, "s"),
             (459, texts[459], 5, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, held_out string")
    labels = [(i, int(i >= 400)) for i in range(460)] + [(3, None), (None, 1), (9009, 1)]
    truth = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.classify(docs, truth).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    out = [r for r in got if r["held_out"] and r["doc_id"] < 460]
    assert sum(r["predicted"] != int("zqvile" in r["text"]) for r in out) <= 2
    same = [r["score"] for r in got if r["text"] == texts[459]]
    assert len(same) == 3 and len(set(same)) == 1
    # What the held-out labels say changes nothing.
    flipped = [(i, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    again = toxicity.classify(docs, spark.createDataFrame(flipped, truth.schema)).collect()
    key = lambda r: (str(r["doc_id"]), r["text"] or "")
    assert [r["score"] for r in sorted(again, key=key)] == pytest.approx([r["score"] for r in sorted(got, key=key)])


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["predicted"] for r in toxicity.classify(docs, none).collect()] == [0]
    only = spark.createDataFrame([(i, 1) for i in range(6)], none.schema)
    assert [r["predicted"] for r in toxicity.classify(docs, only).collect()] == [1]
    assert toxicity.classify(docs.limit(0), only).collect() == []
