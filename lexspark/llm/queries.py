"""The queries, each its operator over a whole table, and the oracle SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, filter_audit, infill, licenses, near_dup, pfor, private_data, quotes, sharding, token_count, tokens, topk, toxicity
from .common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode_decode(table(spark, sf_dir, "documents"))


def op2_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)[0]


def op3_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_pfor_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.token_files(table(spark, sf_dir, "documents"))


def op5_bottom_k_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_separator_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quotes.thread(table(spark, sf_dir, "conversations"))
    return out.withColumn("text_clean", F.sha2(F.coalesce("text_clean", F.lit("")), 256)).withColumnRenamed("text_clean", "clean_sha256")


def op11_boosted_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = private_data.scan(table(spark, sf_dir, "documents"), private_data.train(spark))
    return out.select("doc_id", *[f"n_{k}" for k in private_data.KINDS], F.sha2(private_data.joined(F.col("base")), 256).alias("base_sha256"), private_data.joined(F.col("spans")).alias("spans"))


def op12_event_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = infill.transform(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(c, 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_filter_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_byte_bpe, op2_slot_shards, op3_template_leaks, op4_pfor_files, op5_bottom_k_near_dup, op6_license_index, op7_threshold_topk, op8_separator_counts, op9_counterfactual_toxicity, op10_quote_threads, op11_boosted_private_data, op12_event_infill, op13_filter_matrix)
    return {f.__name__: f for f in own}


_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s)
WHERE r <= 10
"""

_INFILL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT doc_id, x, regexp_extract_all(x, '[A-Za-z]+|[^A-Za-z]') AS u,
         list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS h
  FROM d
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
         CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(x) AS restored_sha256
FROM p
"""

_AUDIT = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), f AS (
  SELECT d.doc_id, part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w), 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x),
         regexp_matches(x, '[#$%&*|]'), coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY x), false)] AS fails,
         d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM d
), g AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), o(filter_order) AS (
  SELECT '' UNION ALL
  SELECT filter_order || l FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) WHERE NOT contains(filter_order, l)
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, list_transform(range(1, step + 1), lambda i: ascii(filter_order[i]) - 64) AS used
  FROM o, range(1, 6) r(step) WHERE length(filter_order) = 5
), e AS (
  SELECT part, filter_order, step, used[-1] AS l, n, good, toxic, fails[used[-1]] AS own,
         len(list_filter(used[:-2], lambda i: fails[i])) > 0 AS earlier, len(list_filter(fails, lambda b: b)) AS many
  FROM g, s
), a AS (
  SELECT part, filter_order, step, l, sum(n) FILTER (NOT own AND NOT earlier) AS kept, sum(n) FILTER (own AND NOT earlier) AS removed,
         sum(n) FILTER (own AND earlier) AS redundant, sum(n) FILTER (own AND many = 1) AS unique_fails,
         sum(good) FILTER (own AND NOT earlier) AS good_lost, sum(toxic) FILTER (own AND NOT earlier) AS toxic_lost
  FROM e GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, l), 0) AS BIGINT) AS shapley
FROM a
"""


def oracle_sql() -> dict[str, str]:
    """Search, fill-in-middle and filter audit: the other results are tested against brute force, round trips and held-out labels."""
    return {"op7_threshold_topk": _TOPK, "op12_event_infill": _INFILL, "op13_filter_matrix": _AUDIT}
