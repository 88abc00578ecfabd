"""Encoders, digest cache, packed files and packing, against the tokenizer libraries."""
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapline.llm import bestfit, bitpack, token_count
from snapline.llm.common import ChunkEncoder, scratch, tokenizer_path

WORD, BYTE, PIECE = "word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"
TEXTS = ["", None, "a", "Hello, world. It's here,and there.\nNew line. x", "  two  spaces ", "tab\tand\nline\n\n",
         "Σας ΣΑΣ é á İ", "x <|endoftext|> y<|startoftext|>", " lead", "a\x1cb c　d", "word " * 3000,
         "same text", "same text", "z" * 5000]
SCHEMA = "doc_id long, text string, n_tokens string, sequence_id int, start date"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, None) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x", 1, None), (None, "no id", "x", 1, None)]
    return spark.createDataFrame(rows, SCHEMA)


_ENC = {k: ChunkEncoder(tokenizer_path(f), k) for f, k in ((WORD, "word"), (BYTE, "byte"))}


@pytest.mark.parametrize("kind", ["word", "byte"])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" .,ab\n\t'é<|>1́"), st.characters(exclude_categories=["Cs"])),
                        max_size=30), max_size=4))
def test_chunks_give_the_librarys_ids(kind, texts):
    e = _ENC[kind]
    ids, size = e.encode(texts)
    at = np.concatenate([[0], np.cumsum(size)])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == e.library(texts)


def test_memory_of_chunks_starts_again():
    e = ChunkEncoder(tokenizer_path(BYTE), "byte", limit=3)
    for t in ("one two three four five six", "seven eight nine ten"):
        assert e.encode([t])[0].tolist() == e.library([t])[0]


def test_token_counts_and_cache(spark, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE))
    cache = scratch(spark, "test-cache")
    got = token_count.count_tokens(docs, tokenizer_path(PIECE), cache)
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == docs.count()
    for r in got.select("text", "n_tokens").collect():
        assert r["n_tokens"] == len(sp.encode(r["text"] or ""))
    stored = token_count.read_cache(spark, cache).count()
    assert stored == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    # A second run finds all of it; a new text is the only miss.
    more = docs.unionByName(spark.createDataFrame([(99, "brand new", "x", 1, None)], SCHEMA))
    assert token_count.count_tokens(more, tokenizer_path(PIECE), cache).count() == more.count()
    assert token_count.read_cache(spark, cache).count() == stored + 1
    assert token_count.count_tokens(docs.limit(0), tokenizer_path(PIECE), cache).count() == 0


@pytest.mark.parametrize("width", [1, 7, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip_and_random_access(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1000, dtype=np.uint64).astype(np.uint32)
    assert (bitpack.unpack(bitpack.pack(ids, width), width, 1000) == ids).all()
    sizes = np.array([0, 10, 490, 500])
    f = bitpack.TokenFile(bitpack.encode_file(ids, np.arange(4), sizes, width, block=96))
    assert all((f.ids(a, b) == ids[a:b]).all() for a, b in ((0, 1000), (95, 97), (3, 3), (999, 1000), (100, 700)))
    assert (f.document(2) == ids[10:500]).all() and len(f.document(0)) == 0
    assert bitpack.bits_for(49408) == 16 and bitpack.bits_for(1) == 1


def test_token_files(spark, docs):
    tok = Tokenizer.from_file(tokenizer_path(WORD))
    got = [tuple(r) for r in bitpack.token_files(docs, tokenizer_path(WORD), "word", 1, file_ids=500)
           .orderBy("start").collect()]
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    keys = sorted(-(1 << 63) if r[0] is None else r[0] for r in rows)
    assert [g[0] for g in got] == keys
    want = {}
    for r in rows:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want[-(1 << 63) if r[0] is None else r[0]] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    at = 0
    for key, start, n, crc in got:
        assert start == at and (n, crc) == want[key]
        at += n
    assert bitpack.token_files(docs.limit(0), tokenizer_path(WORD), "word", 1).count() == 0


def test_open_bins_choose_best_fit_and_close_the_fullest():
    b = bestfit.OpenBins(10, 2)
    assert b.put(6) == (0, 0) and b.put(7) == (1, 0)     # free 4 and 3
    assert b.put(3) == (1, 7)                            # the tighter one, now full
    assert b.put(5) == (2, 0)                            # free 4 and 5
    assert b.put(9) == (3, 0)                            # closes the one with 4 free
    assert b.put(5) == (2, 5) and b.put(4) == (4, 0)
    assert b.put(10) == (5, 0)


def test_best_fit_pack(spark, docs):
    tok = Tokenizer.from_file(tokenizer_path(BYTE))
    got = bestfit.best_fit_pack(docs, tokenizer_path(BYTE), "byte", 2, capacity=64, open_bins=4).toPandas()
    ids = {(-1 if r[0] is None else r[0]): tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
           for r in docs.select("doc_id", "text").collect()}
    total = sum(len(ids[-1 if r[0] is None else r[0]]) for r in docs.select("doc_id").collect())
    assert got["length"].sum() == total
    for r in got.itertuples():
        doc = ids[-1 if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id)]
        part = doc[r.start:r.start + r.length]
        assert len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        assert r.length == 64 if r.piece else r.length <= 64
    s = got.sort_values(["sequence_id", "offset"])
    by = s.groupby("sequence_id")["length"]
    assert (by.sum() <= 64).all() and (by.cumsum() - s["length"] == s["offset"]).all()
    assert got["sequence_id"].nunique() <= total // 64 + 1 + 4 * 8
    assert bestfit.best_fit_pack(docs.limit(0), tokenizer_path(BYTE), "byte", 2).count() == 0
