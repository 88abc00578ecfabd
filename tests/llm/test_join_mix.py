"""Similarity join and source mixing against brute force."""
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapline.llm import ngram_join, pfair
from tests.conftest import SF_SMALL


def shingles(text, n):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if x]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {d: shingles(t, n) for d, t in rows}
    head = {d: d for d in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            head[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def corpus(seed, size):
    """Families of near copies, exact copies, shared passages, short and empty texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 3)))
    passage = " ".join(word() for _ in range(12))
    base = [[word() for _ in range(r.randint(5, 80))] for _ in range(6)]
    out = []
    for i in range(size):
        kind = r.random()
        if kind < 0.6:
            w = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w).upper() if r.random() < 0.1 else " ".join(w))
        elif kind < 0.75:
            out.append(" ".join([word() for _ in range(r.randint(3, 40))]) + "\n" + passage)
        else:
            out.append(r.choice(["", "a", "A b", "x y z", " \t\n", "a a a a a a a", "a a a a a a a a"]))
    return list(enumerate(out))


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 85), (2, 5, 80)])
def test_components_match_brute_force(spark, seed, n, percent):
    rows = corpus(seed, 220)
    df = spark.createDataFrame([(d, t, "x", 5) for d, t in rows], "doc_id long, text string, n string, component_id int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in ngram_join.jaccard_components(df, n=n, percent=percent).collect()}
    assert got == brute(rows, n, percent)


def test_small_texts_with_words_added_or_removed(spark):
    """Pairs whose prefixes are of different length; each pair has words of its own, so no third
    text helps."""
    rows = []
    for size in range(4, 48):
        for more in range(1, 5):
            for front in (True, False):
                w = [f"s{size}m{more}{front}w{i}" for i in range(size + more)]
                d = len(rows)
                rows += [(d, " ".join(w)), (d + 1, " ".join(w[more:] if front else w[:size]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, percent in ((4, 85), (5, 80)):
        want = {}
        for a, b in zip(rows[::2], rows[1::2]):
            want |= brute([a, b], n, percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
               for r in ngram_join.jaccard_components(df, n=n, percent=percent).collect()}
        assert got == want


def test_components_edge_rows(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (7, text + " more"), (8, None), (9, ""), (None, text), (10, text), (11, "q"), (11, text)]
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    of = {r["doc_id"]: r["component_id"] for r in got}
    assert of[5] == of[7] == of[10] == 5 and of[8] == 8 and of[9] == 9 and of[None] is None and of[11] in (5, 11)


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(3, 2)], "x long, y long")
    nodes = spark.range(165).withColumnRenamed("id", "doc_id")
    got = {r[0]: r[1] for r in ngram_join.components(nodes, links).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and got[3] == 2 and got[161] == 161


def test_divide_skip_settles_the_overlap_exactly():
    r = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(r.integers(0, 120, r.integers(1, 100))).astype(np.uint64)
        b = np.unique(r.integers(0, 120, r.integers(1, 100))).astype(np.uint64)
        want = 100 * len(np.intersect1d(a, b)) >= 60 * len(np.union1d(a, b))
        assert ngram_join.divide_skip(a, [b], 60) == [want]


@pytest.mark.parametrize("weights", [[1], [3, 1], [5, 3, 2], [7, 1, 1, 1], [1] * 9 + [40], [13, 8, 5, 3, 2, 1]])
def test_period_keeps_every_source_within_one_block(spark, weights):
    col = F.array(*[F.lit(w) for w in weights])
    slots = spark.range(1).select(pfair.edf_period(col).alias("s")).first()["s"]
    q = sum(weights)
    assert len(slots) == q
    given = np.zeros(len(weights))
    for t, s in enumerate(slots, 1):
        given[s] += 1
        assert (np.abs(given - np.array(weights) * t / q) < 1).all()


def edf_by_heap(sized):
    """Slots of every phase, (phase, source) -> slots in order, by a heap over single sources."""
    import heapq
    until = {s: -(-b // w) for s, w, b in sized}
    out = {}
    for phase, end in enumerate(sorted(set(until.values()))):
        live = [(s, w) for s, w, b in sized if until[s] >= end]
        q = sum(w for _, w in live)
        member, seen = {}, {}
        for s, w in sorted(live, key=lambda x: (-until[x[0]], x[0])):
            member[s] = seen[w] = seen.get(w, -1) + 1
        released = {}
        for s, w in live:
            for j in range(w):
                released.setdefault(j * q // w, []).append((-(-(j + 1) * q // w), w, j, member[s], s))
        heap = []
        for t in range(q):
            for x in released.get(t, []):
                heapq.heappush(heap, x)
            due, _, _, _, s = heapq.heappop(heap)
            assert t < due
            out.setdefault((phase, s), []).append(t)
    return out


def sized_of(spark, sized):
    return spark.createDataFrame(sized, "_src string, weight int, n_blocks long")


def test_schedule_is_that_of_a_heap_over_single_sources(spark):
    r = np.random.default_rng(5)
    for n in (1, 2, 7, 40):
        sized = [(f"s{i:02}", int(r.integers(1, 9)), int(r.integers(1, 60))) for i in range(n)]
        runs = pfair.ranked(sized_of(spark, sized)).cache()
        source = {(x["weight"], x["_member"]): x["_src"] for x in runs.collect()}
        got = {}
        for x in sorted(pfair.schedule(runs).collect(), key=lambda x: (x["_phase"], x["_job"])):
            got.setdefault((x["_phase"], source[x["_weight"], x["_member"]]), []).append(x["slot"])
        assert got == edf_by_heap(sized)


def test_schedule_of_ten_thousand_sources(spark):
    """A source per domain: one large, thousands of single blocks, every weight kept within a block."""
    r = np.random.default_rng(6)
    sized = [("s00000", 300, 40_000)] + [
        (f"s{i:05}", int(w), int(b)) for i, w, b in zip(range(1, 10_000), r.zipf(2.5, 9999).clip(1, 60), r.zipf(1.8, 9999).clip(1, 500))]
    runs = pfair.ranked(sized_of(spark, sized)).cache()
    slots = pfair.schedule(runs).groupBy("_phase").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).collect()
    until = {s: -(-b // w) for s, w, b in sized}
    ends = sorted(set(until.values()))
    assert len(slots) == len(ends)
    for x in slots:
        q = sum(w for s, w, _ in sized if until[s] >= ends[x["_phase"]])
        assert x["n"] == x["d"] == x["m"] + 1 == q
    periods = spark.range(ends[-1]).select("id", pfair.phase_of(F.col("id"), ends).alias("p")).collect()
    assert [x["p"] for x in periods] == list(np.searchsorted(ends, [x["id"] for x in periods], side="right"))


def test_mix_places_every_row_once_and_on_target(spark):
    rows = [(i, "big" if i % 3 else "mid" if i % 2 else None, "x", 1, 2) for i in range(900)] + [(7, "tiny", "x", 1, 2)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, slot string, until int, first_period int")
    w = spark.createDataFrame([("big", 3), ("mid", 2), (None, 1)], "source string, weight int")
    got = pfair.mix(df, w, block_rows=10, rows_per_bucket=50).toPandas()
    assert len(got) == len(rows) and sorted(got["doc_id"]) == sorted(r[0] for r in rows)
    assert {"until", "first_period"} <= set(got.columns)
    assert not got.duplicated(["period", "slot", "place"]).any()
    blocks = got.sort_values(["period", "slot", "place"]).drop_duplicates(["period", "slot"])
    first = blocks[blocks["period"] == 0]
    assert first["source"].fillna("null").value_counts().to_dict() == {"big": 3, "mid": 2, "null": 1, "tiny": 1}
    # Once the others have ended the largest goes on alone, in whole blocks.
    assert (got.groupby(["period", "slot"])["source"].nunique(dropna=False) == 1).all()
    again = pfair.mix(df.select("doc_id", "source"), w, block_rows=10, rows_per_bucket=50).toPandas()
    cols = ["doc_id", "period", "slot", "place"]
    assert got[cols].sort_values(cols).values.tolist() == again[cols].sort_values(cols).values.tolist()


def test_mix_edge_tables(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert pfair.mix(none).count() == 0
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = pfair.mix(docs)
    assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
