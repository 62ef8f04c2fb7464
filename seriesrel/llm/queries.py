"""One query per operator over its whole table, and DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesrel.llm import (bagminhash, bpe, exact, group_prefix, html_template, pii, pivotal_grams, ppm, quality, spaced_seeds,
                           token_links, url_lists, wavelet)
from seriesrel.session import scratch_path

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_main(_read(spark, sf_dir, "pages"))


def op2_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_classes(_read(spark, sf_dir, "documents"))


def op3_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return pii.digest(pii.find_pii(docs, pii.train(docs)))


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    out = url_lists.filter_urls(url_lists.dated_captures(pages), url_lists.dated_entries(pages))
    return out.withColumn("fetched", F.date_format("fetched", "yyyy-MM-dd HH:mm:ss"))


def op5_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    wavelet.write_shards(_read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), path)
    return wavelet.read_documents(spark, path)


def quality_weights(docs: DataFrame, labels: DataFrame):
    """Weights from the labelled rows that are not held out.

    The labels are sampled before the join, so that their bounded sample
    (``quality.MAX_ROWS``) goes to the documents and no text is exchanged.
    """
    usable = labels.select("doc_id", F.col("quality").alias("label")).where(quality_fold() > 0)
    some = ppm.sampled(usable.where("label IN (0, 1)"), quality.MAX_ROWS)
    return quality.train(docs.select("doc_id", "text").join(F.broadcast(some), "doc_id"))


def quality_fold():
    return ppm.fold("doc_id", 5)


def op6_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_weights(docs, _read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (quality_fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spaced_seeds.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op8_bpe_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op9_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    counts = ppm.train(docs.where(ppm.fold("doc_id", 4) != 2))
    out = ppm.identify(docs, counts)
    return out.select("doc_id", (ppm.fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_exact_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(_read(spark, sf_dir, "documents"))


def op11_group_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_prefix.link_classes(_read(spark, sf_dir, "documents"))


def op12_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivotal_grams.spelling_forms(_read(spark, sf_dir, "documents"))


def op13_token_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return token_links.digest(token_links.links(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_template, op2_bagminhash, op3_pii_tagger, op4_url_lists, op5_wavelet_tokens,
                            op6_quality_ftrl, op7_spaced_seeds, op8_bpe_queue, op9_language_ppm, op10_exact_refinement, op11_group_prefix,
                            op12_pivotal_grams, op13_token_links)}

SQL: dict[str, str] = {}

SQL["op10_exact_refinement"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT doc_id, x, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM g
"""

SQL["op4_url_lists"] = r"""
WITH caps AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_minutes((page_id * 7919) % 525600) AS fetched,
         lower(regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)) AS host,
         regexp_extract(coalesce(url, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]+/([^/?#]+)', 1) AS seg
  FROM pages),
hosts AS (SELECT DISTINCT host FROM caps WHERE host <> ''),
h AS (SELECT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS d, regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS parent FROM hosts),
e AS (
  SELECT 'abuse' AS list_name, host AS pattern, 'block' AS action, 0 AS day FROM h WHERE regexp_matches(host, 'spam|pills')
  UNION ALL SELECT 'abuse', host, 'block', d % 200 FROM h WHERE NOT regexp_matches(host, 'spam|pills') AND d % 3 = 0
  UNION ALL SELECT 'abuse', host, 'unlist', d % 200 + 20 + d % 50 FROM h WHERE NOT regexp_matches(host, 'spam|pills') AND d % 3 = 0
  UNION ALL SELECT 'abuse', host, 'block', d % 200 + 80 + d % 50 FROM h WHERE NOT regexp_matches(host, 'spam|pills') AND d % 3 = 0
  UNION ALL SELECT 'review', parent, 'block', 60 FROM h WHERE d % 4 = 0 AND parent <> ''
  UNION ALL SELECT 'review', parent, 'unlist', 150 FROM h WHERE d % 4 = 0 AND parent <> ''
  UNION ALL SELECT 'review', host || '/en', 'allow', 90 FROM h WHERE d % 4 = 0 AND parent <> ''
  UNION ALL SELECT 'review', host || '/es', 'block', d % 200 FROM h WHERE NOT (d % 4 = 0 AND parent <> '')),
one AS (SELECT list_name, pattern, TIMESTAMP '2024-01-01 00:00:00' + to_days(day::INT) AS effective,
               max(CASE action WHEN 'unlist' THEN 0 WHEN 'block' THEN 1 ELSE 2 END) AS rank FROM e GROUP BY ALL),
spans AS (SELECT list_name, pattern, rank, effective AS f, lead(effective) OVER (PARTITION BY list_name, pattern ORDER BY effective) AS t FROM one),
active AS (
  SELECT c.page_id, s.list_name, s.pattern, s.rank FROM caps c JOIN spans s
    ON (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern) OR (c.seg <> '' AND c.host || '/' || c.seg = s.pattern))
   AND s.rank > 0 AND s.f <= c.fetched AND (s.t IS NULL OR c.fetched < s.t)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id, list_name ORDER BY length(pattern) DESC, pattern DESC) AS k FROM active),
verdict AS (
  SELECT page_id, count(*) AS n_active,
         coalesce(string_agg(CASE WHEN k = 1 AND rank = 1 THEN list_name || ':' || pattern END, ',' ORDER BY list_name || ':' || pattern), '') AS decided_by
  FROM ranked GROUP BY page_id)
SELECT page_id, url, strftime(fetched, '%Y-%m-%d %H:%M:%S') AS fetched, coalesce(n_active, 0) AS n_active,
       coalesce(decided_by, '') AS decided_by, coalesce(decided_by, '') <> '' AS blocked
FROM caps LEFT JOIN verdict USING (page_id)
"""

SQL["op7_spaced_seeds"] = r"""
WITH dw AS (SELECT doc_id, (string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')) AS w FROM documents),
iw AS (SELECT DISTINCT item_id, (string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ')) AS w FROM benchmark),
dp AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM dw),
ip AS (SELECT item_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM iw WHERE w[1] <> ''),
m AS (SELECT doc_id, item_id, n, p - q AS diag, q FROM dp JOIN ip USING (word)),
s AS (SELECT doc_id, item_id, n, diag, q,
             count(*) OVER (PARTITION BY doc_id, item_id, n, diag ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM m)
SELECT doc_id, item_id, max(c)::INT AS matched FROM s WHERE c >= CASE WHEN n >= 13 THEN 11 WHEN n >= 8 THEN n - 1 ELSE n END GROUP BY doc_id, item_id
"""
