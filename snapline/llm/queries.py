"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm import (
    bestfit, bitpack, html_mincut, importance, kneser_ney, ngram_join, pfair, pii, quality_rules, syncmer, token_count,
    toxicity, vector_codes)
from snapline.llm.common import scratch, table, text_of, tokenizer_path


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are 85 % alike."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.jaccard_components(docs, n=4, percent=85)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary, through a cache of its own that
    starts empty (``spark.snapline.tokenCache`` names a lasting one)."""
    cache = spark.conf.get("spark.snapline.tokenCache", None) or scratch(spark, "token-cache")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.octet_length(text_of()).cast("long").alias("n_bytes"))
    counted = token_count.count_tokens(docs, tokenizer_path("piece_bpe_32k.model"), cache)
    return counted.select("doc_id", "n_bytes", "n_tokens",
                          (F.col("n_tokens") > 4096).alias("over_limit"))


def op3_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix of its sources by flattened weights."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair.mix(docs, key=["doc_id"])


def op4_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likenesses."""
    return syncmer.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the 49k word vocabulary, written bit-packed and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bitpack.token_files(docs, tokenizer_path("word_bpe_49k.json"), "word", 1).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, threshold and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return kneser_ney.classify(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "lang", "perplexity", "threshold", "accepted")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and checksum of the base spans, all spans."""
    return pii.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_mincut.extract(pages).select("page_id", "url", "text", "n_chars")


def op9_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of the standard rules for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids of the 50k byte vocabulary."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bestfit.best_fit_pack(docs, tokenizer_path("byte_bpe_50k.json"), "byte", 2)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, their errors, and the digest of the codebooks."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn to look like the benchmark."""
    return importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark").select("text")).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")).select(
        "doc_id", "held_out", "score", "predicted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the documents."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_token_counts": op2_token_counts,
    "op3_pfair_mix": op3_pfair_mix,
    "op4_closed_syncmers": op4_closed_syncmers,
    "op5_token_files": op5_token_files,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_pii": op7_pii,
    "op8_html_mincut": op8_html_mincut,
    "op9_quality_cascade": op9_quality_cascade,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_importance": op12_importance,
    "op13_toxicity": op13_toxicity,
    "pipeline": pipeline,
}

def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The codebook rounds written out, one pair of steps each: nearest entries, new entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (
  SELECT id, p, arg_min(j, (d, j)) AS j, min(d) AS d FROM (
    SELECT v.id, v.p, c.j, list_sum(list_transform(v.x, lambda q, i: (q - c.x[i]) * (q - c.x[i]))) AS d
    FROM v JOIN c{r} c ON c.p = v.p) GROUP BY id, p)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS (
  SELECT c.p, c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT p, j, list(y ORDER BY i) AS x FROM (
      SELECT v.p, a.j, u.i, CAST((sum(v.x[u.i]) - ((sum(v.x[u.i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS y
      FROM v JOIN a{r} a USING (id, p), unnest(range(1, len(v.x) + 1)) AS u(i) GROUP BY v.p, a.j, u.i)
    GROUP BY p, j) m ON m.p = c.p AND m.j = c.j)""")
    body = ",\n".join(steps)
    return f"""
WITH k AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
                  list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT id, p, x[p * len(x) // {parts} + 1:(p + 1) * len(x) // {parts}] AS x FROM k, unnest(range({parts})) AS r(p)),
c0 AS (SELECT p, id AS j, x FROM v WHERE id < {entries}),
{body},
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, j)) AS h FROM c{rounds}),
e AS (SELECT id, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM a{rounds} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM k JOIN e USING (id), book"""


# The others rest on tokenizers, trained models, hashes or graph search; tests hold them against
# brute force.
ORACLE: dict[str, str] = {"op1_ngram_join": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 4 THEN array_to_string(ws, ' ')
             ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] END AS g
      FROM d, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS r(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= 85 * (nx.n + ny.n - k)),
links AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id, doc_id AS other FROM d
          UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.other) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op9_quality_cascade": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM w, unnest(range(1, len(ws) - 1)) AS r(i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again)
            GROUP BY doc_id),
m AS (SELECT w.*, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > 0.1::DOUBLE * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR n_dup_lines > 0.5::DOUBLE * n_lines
            OR length(regexp_replace(t, '[^0-9]+', '', 'g')) > 0.3::DOUBLE * greatest(length(t), 1)
            OR len(list_filter(ws, lambda x: x = upper(x) AND x <> lower(x))) > 0.5::DOUBLE * n_words
            OR len(list_distinct(ws)) < 0.05::DOUBLE * n_words
            OR len(regexp_extract_all(t, '\.\.\.|…')) > 0.3::DOUBLE * n_lines + 10) AS kept
FROM b""",
    "op11_vector_codes": _vector_codes_sql(),
    "op12_importance": r"""
WITH RECURSIVE t AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM t),
f AS (SELECT side, doc_id, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM w),
u AS (SELECT g, hex(encode(g)) AS h, octet_length(encode(g)) AS n FROM (SELECT DISTINCT g FROM f)),
longest AS (SELECT max(n) AS n FROM u),
byte AS (SELECT i AS b, list_reduce(list_prepend(i, range(8)), lambda c, k:
              CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i)),
ahead AS (SELECT 0 AS d, b, v FROM byte
          UNION ALL SELECT d + 1, a.b, xor(a.v >> 8, byte.v) FROM ahead a JOIN byte ON byte.b = a.v & 255
          WHERE d + 1 < (SELECT n FROM longest)),
zeros AS (SELECT 0 AS n, CAST(4294967295 AS BIGINT) AS z
          UNION ALL SELECT n + 1, xor(z >> 8, byte.v) FROM zeros JOIN byte ON byte.b = z & 255
          WHERE n < (SELECT n FROM longest)),
p AS (SELECT g, n, n - 1 - i AS d, CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT) AS b FROM u, unnest(range(n)) AS r(i)),
k AS (SELECT g, xor(xor(x, z), 4294967295) % 10000 AS bucket
      FROM (SELECT g, any_value(n) AS n, bit_xor(v) AS x FROM p JOIN ahead USING (d, b) GROUP BY g) JOIN zeros USING (n)),
fb AS (SELECT side, doc_id, bucket FROM f JOIN k USING (g)),
n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM fb GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM n) + 10000) AS DOUBLE)
                                          / CAST((s + 1) * ((SELECT sum(t) FROM n) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM n),
d AS (SELECT doc_id, count(*) AS n, sum(gain) AS total FROM fb JOIN g USING (bucket) WHERE side = 0 GROUP BY doc_id),
x AS (SELECT w.doc_id, len(ws) AS words, coalesce(n, 0) AS n_features, coalesce(CAST(floor(total / n) AS BIGINT), 0) AS weight,
             CAST('0x' || substr(sha256('7:' || w.doc_id), 1, 8) AS BIGINT) AS h
      FROM w LEFT JOIN d USING (doc_id) WHERE side = 0),
y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM x),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM y WHERE words >= 20)
SELECT y.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
       CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM y LEFT JOIN r USING (doc_id)"""}
