"""Token counts through a digest cache."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapline.llm.common import batched, cut, small_batches, text_of

CACHE_SCHEMA = T.StructType([
    T.StructField("digest", T.BinaryType()),
    T.StructField("tokenizer", T.StringType()),
    T.StructField("n_tokens", T.LongType()),
])


def tokenizer_digest(path: str) -> str:
    """Version of a tokenizer: the digest of its vocabulary file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _counter(path: str):
    if path.endswith(".model"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def _encode_misses(path: str, version: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(path)
        for pdf in frames:
            texts = pdf["content"].tolist()
            n = [c for lo, hi in batched(texts) for c in count(texts[lo:hi])]
            yield pd.DataFrame({"digest": pdf["digest"], "tokenizer": version, "n_tokens": n})
    return run


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts, empty when nothing was stored yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, *, text: str = "text",
                 out: str = "n_tokens") -> DataFrame:
    """Add ``out``, the number of tokens of the whole text, to every row of ``docs``.

    Texts are keyed by the SHA-256 of their normalised content (null becomes the empty text;
    the tokenizers normalise for themselves, so nothing else may be changed without changing
    counts) and the digest of the vocabulary file. Contents that the cache at ``cache_path``
    does not hold are reduced to one row per digest, encoded, and appended to it; then every
    row takes its count from the cache.

    A text that fills many rows is reduced map-side before the shuffle, so it reaches its task
    once per map task. The last join carries digests only; a hot digest is left to Spark's
    skew join, which splits it. Two jobs that append the same digest at once store equal
    counts; readers take one of them. An empty table gives an empty result. A column of
    ``docs`` named like ``out`` is replaced; all others stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_digest(model_path)
    content = text_of(text)
    digest = F.unhex(F.sha2(content, 256))
    stored = read_cache(spark, cache_path).where(F.col("tokenizer") == version)
    distinct = (docs.select(digest.alias("digest"), content.alias("content"))
                .dropDuplicates(["digest"]))
    misses = distinct.join(stored.select("digest"), "digest", "left_anti")
    (misses.mapInPandas(_encode_misses(model_path, version), CACHE_SCHEMA)
     .write.mode("append").parquet(cache_path))
    counts = cut(read_cache(spark, cache_path).where(F.col("tokenizer") == version)
                 .groupBy("digest").agg(F.max("n_tokens").alias("_n_tokens")), "token-counts")
    keyed = docs.withColumn("_digest", digest).drop(out)
    return (keyed.join(counts.withColumnRenamed("digest", "_digest"), "_digest", "left")
            .withColumnRenamed("_n_tokens", out).drop("_digest"))
