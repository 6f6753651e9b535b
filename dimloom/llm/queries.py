"""The registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimloom.llm import audit, bpe, decontaminate, disclosure, langid, licences, pages, ppm, pq, quality, simhash, toxicity, whitening
from dimloom.llm.common import fold, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.select("doc_id", "toxic").filter(fold("doc_id", 5) != 0))
    return toxicity.scores(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ppm.fit(docs.filter(fold("doc_id", 5) != 1).select("text"))
    return ppm.score(docs, model).withColumn("held_out", fold("doc_id", 5) == 1)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages")
    return pages.extract(rows, pages.fit(rows))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.fit(docs))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.links(table(spark, sf_dir, "embeddings"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 4) != 2).select("text", "lang"))
    return langid.predict(docs, model).withColumn("held_out", fold("doc_id", 4) == 2).select(
        "doc_id", "held_out", "lang_pred", "score", "languages", "proportions")


def op10_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.digests(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.select("doc_id", "quality").filter(fold("doc_id", 4) != 2))
    return quality.scores(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.components(rows, whitening.fit(rows))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_toxicity, op2_ppm_scores, op3_html_extraction, op4_license_scan, op5_simhash_near_dedup, op6_benchmark_decontamination, op7_bpe_coding, op8_embedding_near_dedup, op9_language_id, op10_pii_disclosure,
        op11_filter_audit, op12_quality, op13_embedding_whitening)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the operators that SQL can express."""
    return {"op6_benchmark_decontamination": OP6, "op8_embedding_near_dedup": OP8, "op11_filter_audit": OP11}


OP6 = r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
win AS (
  SELECT DISTINCT item_id, list_slice(ws, i, i + least(len(ws), 10) - 1) AS w, least(len(ws), 10) AS n
  FROM item, unnest(range(1, greatest(len(ws) - 10, 0) + 2)) AS t(i) WHERE len(ws) > 0),
seen AS (
  SELECT doc_id, i AS pos, n, list_slice(ws, i, i + n - 1) AS w
  FROM doc, (SELECT DISTINCT n FROM win) AS lens, unnest(range(1, len(ws) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, pos, seen.n AS n, item_id FROM seen JOIN win ON seen.w = win.w),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(pos, pos + n)) AS t(p) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc.doc_id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word ON doc.doc_id = word.doc_id LEFT JOIN named ON doc.doc_id = named.doc_id
"""

OP8 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN class ON vec_id = class.a LEFT JOIN degree ON vec_id = degree.a
"""

OP11 = r"""
WITH doc AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
flag AS (
  SELECT doc_id, part, CAST(len(ws) < 50 AS INTEGER) AS a, CAST(100 * len(list_distinct(ws)) < 65 * len(ws) AS INTEGER) AS b,
         CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) AS INTEGER) AS c,
         CAST(regexp_matches(t, '[#$%&*|]') AS INTEGER) AS d,
         CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INTEGER) AS e FROM doc),
marked AS (
  SELECT doc_id, CAST(coalesce(bool_or(quality = 1), false) AS INTEGER) AS good, CAST(coalesce(bool_or(toxic = 1), false) AS INTEGER) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cell AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM flag LEFT JOIN marked ON flag.doc_id = marked.doc_id GROUP BY ALL),
letter AS (SELECT chr(65 + CAST(i AS INTEGER)) AS l, CAST(1 << i AS INTEGER) AS bit FROM range(5) AS t(i)),
perm AS (
  SELECT p.l || q.l || r.l || s.l || u.l AS filter_order, [p.bit, q.bit, r.bit, s.bit, u.bit] AS bits
  FROM letter p JOIN letter q ON p.l <> q.l JOIN letter r ON r.l NOT IN (p.l, q.l) JOIN letter s ON s.l NOT IN (p.l, q.l, r.l)
  JOIN letter u ON u.l NOT IN (p.l, q.l, r.l, s.l)),
step AS (
  SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, coalesce(list_sum(list_slice(bits, 1, i - 1)), 0)::INTEGER AS before
  FROM perm, range(1, 6) AS t(i)),
told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cell, step GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""
