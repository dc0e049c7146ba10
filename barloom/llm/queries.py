"""The queries of the ten operators over their whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import covertree, html, jaccard, licenses, media, packing, pieces, quality, suffixes, toxicity
from barloom.llm.common import table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.top_k(table(spark, sf_dir, "embeddings"), k=20, scale=64.0, every=20)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), jaccard.Threshold(85, 100, words=4))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"), min_words=50).drop("source_ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER), capacity=2048, end_id=0)


def op9_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_and_read(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_license_scan, op2_sentencepiece, op3_html_text, op4_exact_top_k, op5_ngram_jaccard, op6_suffix_dedup, op7_toxicity, op8_best_fit_packing, op9_jpeg_media, op10_quality)
    return {f.__name__: f for f in ops}


SPACE = r"[ \t\n\v\f\r]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda x: x <> '')"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_transform({WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 1) + 1), lambda i: array_to_string(ws[i:i + 3], ' '))) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.c + y.c - i)),
r(doc_id, other) AS (SELECT a, b FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other)
SELECT w.doc_id, coalesce(any_value(n.c), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.other), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id GROUP BY w.doc_id"""

SUFFIXES = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s + 1:s + 50], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 49)) AS s FROM w WHERE len(ws) >= 50)),
dup AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
cut AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS first FROM dup),
isle AS (SELECT doc_id, s, sum(first) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM cut),
span AS (SELECT doc_id, min(s) AS a, max(s) + 50 AS b FROM isle GROUP BY doc_id, g)
SELECT d.doc_id, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_repeated, CAST(count(a) AS BIGINT) AS n_spans,
       coalesce(string_agg(a || '-' || b, ' ' ORDER BY a), '') AS spans
FROM documents d LEFT JOIN span ON span.doc_id = d.doc_id GROUP BY d.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": licenses.oracle(), "op4_exact_top_k": TOP_K, "op5_ngram_jaccard": JACCARD, "op6_suffix_dedup": SUFFIXES}
