"""Training corpus from ``documents``: quality classifier, near-duplicate join, personal data,
mixing of sources, packing into sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm import bestfit, kneser_ney, ngram_join, pfair, pii
from snapline.llm.common import cut, table, tokenizer_path

# Shingles of five words, similarity of 0.8 or more.
WORDS, PERCENT = 5, 80


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with its columns called ``names`` set aside under other names, and the columns
    that give them back."""
    held = {c: f"_own_{c}" for c in docs.columns if c in names}
    back = [F.col(held[c]).alias(c) if c in held else F.col(c) for c in docs.columns]
    return docs.withColumnsRenamed(held), back


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity stays below their language's threshold."""
    own, back = _aside(docs, ("perplexity", "threshold", "accepted"))
    return kneser_ney.classify(own, table(spark, sf_dir, "labels")).where("accepted").select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Of rows that
    repeat an id one stays; rows without an id are not compared and stay."""
    found = cut(ngram_join.jaccard_components(docs.select("doc_id", "text"), n=WORDS, percent=PERCENT),
                "pipeline-components")
    gone = found.where("doc_id is not null and component_id <> doc_id").select("doc_id").distinct()
    few = gone.count() <= ngram_join.BROADCAST_IDS
    kept = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(*docs.columns)
    named = found.where("doc_id is not null")
    if named.count() > named.select("doc_id").distinct().count():
        kept = (kept.where("doc_id is not null").dropDuplicates(["doc_id"])
                .unionByName(kept.where("doc_id is null")))
    return kept


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind in brackets; n_chars follows."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix of their sources."""
    own, back = _aside(docs, pfair.MIX)
    return pfair.mix(own, key=["doc_id", "n_chars"]).orderBy("period", "slot", "place").select(*back)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids, along the order of the mix."""
    return bestfit.best_fit_pack(docs, tokenizer_path("byte_bpe_50k.json"), "byte", 2, in_order=True)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("PII", personal_data),
          ("mixing sources", mixed), ("best-fit packing", packed)]

# Perplexities and tokenizers are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
