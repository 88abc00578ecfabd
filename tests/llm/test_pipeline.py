"""The corpus pipeline, stage by stage, against brute force; the registration of the queries."""
import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from snapline.llm import kneser_ney, pii
from snapline.llm.common import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, period int, threshold string, sig binary"
WORDS = "the rain in spain stays mainly on a plain and tom runs to see what is left of it now".split()


def rows():
    r = random.Random(9)
    out = []
    for i in range(60):
        out.append(" ".join(r.choice(WORDS) for _ in range(r.randint(30, 90))))
    out += [out[3], out[3] + " now", out[4].replace("rain", "rein", 1), out[5] + " " + out[6],
            "".join(r.choice("#*QXZ%9") for _ in range(300)), "", "tom", "tom"]
    for i in (10, 11, 12):                  # trusted, so they stay
        out[i] += " call +1 (372) 555-2774 or ann@mail.example.com"
    full = [(i, t, "en" if i % 5 else None, ["a", "a", "b", None][i % 4], len(t), 1, "x", b"s") for i, t in enumerate(out)]
    return full + [(100, None, "en", "b", None, None, None, None), (None, out[7], "en", "a", 5, 1, "x", b"s")]


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(64, 0, 0)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{d}/labels.parquet")
    return d


def plain(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def shingles(t, n=5):
    w = (t or "").lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    step = dict(corpus_pipeline.STAGES)
    assert list(step) == ["quality classifier", "n-gram Jaccard join", "PII", "mixing sources", "best-fit packing"]
    labels = spark.read.parquet(f"{data}/labels.parquet")

    good = step["quality classifier"](spark, docs, data)
    verdict = kneser_ney.classify(docs, labels)
    assert plain(good.select("doc_id", "text")) == plain(verdict.where("accepted").select("doc_id", "text"))
    assert good.exceptAll(docs).count() == 0
    assert good.columns == docs.columns and 64 not in [r[0] for r in plain(good)]
    assert good.where("doc_id < 60").count() == 60 and good.where("doc_id = 100").count() == 1

    kept = step["n-gram Jaccard join"](spark, good, data)
    sets = {r[0]: shingles(r[1]) for r in plain(good) if r[0] is not None}
    head = {d: d for d in sets}
    for _ in range(3):
        for a, b in combinations(sorted(sets), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                head[a] = head[b] = min(head[a], head[b])
    want = [r for r in plain(good) if r[0] is None or head[r[0]] == r[0]]
    assert plain(kept) == want and len(want) < good.count()

    clean = step["PII"](spark, kept, data)
    none = np.zeros(0)
    for before, after in zip(plain(kept), plain(clean)):
        text = pii.mask(before[1], pii.find(before[1], none)) if before[1] else before[1]
        assert after[1] == text and after[4] == (before[4] if text == before[1] else len(text))
    assert any("[PHONE]" in (r[1] or "") and "[EMAIL]" in r[1] for r in plain(clean))

    mixed = step["mixing sources"](spark, clean, data)
    assert mixed.columns == docs.columns and plain(mixed) == plain(clean)

    packed = step["best-fit packing"](spark, mixed, data).toPandas()
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ids = {r[0]: tok.encode(r[1] or "", add_special_tokens=False).ids + [2] for r in plain(mixed) if r[0] is not None}
    for r in packed[packed["doc_id"].notna()].itertuples():
        part = ids[int(r.doc_id)][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert packed[packed["doc_id"].notna()]["length"].sum() == sum(map(len, ids.values()))
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_run_and_empty_tables(spark, data, tmp_path):
    assert corpus_pipeline.ORACLE_SQL is None
    whole = E.queries()["pipeline"](spark, data)
    assert whole.columns[:2] == ["doc_id", "piece"] and whole.count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_sequences_follow_the_mix(spark, tmp_path, monkeypatch):
    """Changed weights change the sequences, whose numbers run along the mixed order."""
    from snapline.llm import bestfit, pfair
    step = dict(corpus_pipeline.STAGES)
    text = " ".join(WORDS * 20)
    docs = spark.createDataFrame([(i, text + f" {i}", "en", "a" if i % 3 else "b", 1, 1, "x", b"s") for i in range(1200)], SCHEMA)
    plain_mix, found = pfair.mix, {}
    for name, a, b in (("more a", 9, 1), ("more b", 1, 9)):
        weights = spark.createDataFrame([("a", a), ("b", b)], "source string, weight int")
        monkeypatch.setattr(pfair, "mix", lambda d, **kw: plain_mix(d, weights, **kw))
        step["mixing sources"](spark, docs, "").write.parquet(f"{tmp_path}/{a}")
        again = spark.read.parquet(f"{tmp_path}/{a}")
        ordered = plain_mix(docs, weights, key=["doc_id", "n_chars"]).orderBy("period", "slot", "place")
        place = {r["doc_id"]: r["_place"] for r in bestfit.in_row_order(again).collect()}
        assert [r["doc_id"] for r in ordered.collect()] == sorted(place, key=place.get)
        got = step["best-fit packing"](spark, again, "").collect()
        assert len({r["doc_id"] for r in got}) == 1200
        first = {}
        for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
            first.setdefault(r["doc_id"], r["sequence_id"])
        found[name] = [d for d in sorted(first, key=lambda d: (first[d], d))]
    share = {k: sum(d % 3 == 0 for d in v[:300]) / 300 for k, v in found.items()}
    assert share["more a"] < 0.4 < 0.6 < share["more b"]


def test_repeated_ids_leave_one_document(spark, data):
    t = " ".join(WORDS * 3)
    df = spark.createDataFrame([(1, t, "en", "a", 3, 1, "x", b"s")] * 3 + [(2, t, "en", "a", 3, 1, "x", b"s"), (None, t, "en", "a", 3, 1, "x", b"s")] * 2, SCHEMA)
    got = corpus_pipeline.near_duplicates(spark, df, data)
    assert [r[0] for r in plain(got)] == [1, None, None]


def test_every_operator_has_one_query():
    names = [n for n in E.queries() if n[:2] == "op" and n[2:3].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert "pipeline" in E.queries()
