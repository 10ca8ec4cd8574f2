"""The registered queries of this package: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from demandspark.llm.bpe_count import count_tokens
from demandspark.llm.bpe_encode import encode_documents
from demandspark.llm.clusters import centroid_clusters
from demandspark.llm.common import table
from demandspark.llm.html_extract import extract
from demandspark.llm.mixing import mix_sources, taken_words
from demandspark.llm.near_dedup import near_duplicates
from demandspark.llm.quality import judged
from demandspark.llm.quotations import linked_conversations
from demandspark.llm.resampling import resampled
from demandspark.llm.substring_dedup import kept_words
from demandspark.llm.topk import top_products
from demandspark.llm.toxicity import toxicity
from demandspark.llm.vocabularies import BYTE_BPE, WORD_BPE
from demandspark.llm.warc import archived


def op1_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


def op4_exact_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), k=20, every=20)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_conversations(table(spark, sf_dir, "conversations"))


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(mix_sources(table(spark, sf_dir, "documents")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_words(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), WORD_BPE, limit=2048)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed=3)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, seed=42).drop("n_words")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), least=1000).drop("url")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_bpe_encoding, op2_html_extraction, op3_quality_rules, op4_exact_topk_search, op5_minhash_near_dedup, op6_quotation_linking,
        op7_mixing_sources, op8_toxicity, op9_substring_dedup, op10_token_counts, op11_centroid_clustering, op12_importance_resampling, op13_warc, pipeline,
    )
    return {f.__name__: f for f in every}


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


SUBSTRING_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13
), firsts AS (
  SELECT k, min(doc_id) AS f FROM windows GROUP BY k
), covered AS (
  SELECT DISTINCT doc_id, i + j AS p FROM windows JOIN firsts USING (k), range(0, 13) AS r(j) WHERE f < doc_id
), places AS (
  SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS line FROM places ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_removed, sha256(COALESCE(line, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def clusters_sql(k: int = 8, rounds: int = 10, seed: int = 3, width: int = 64, scale: int = 1024) -> str:
    """Lloyd's rounds, one after the other, over (vector, component) rows."""
    steps = [f"""v AS MATERIALIZED (
  SELECT vec_id, i, CAST(floor({scale} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x FROM embeddings, range(1, {width + 1}) AS t(i)
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), o AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS j FROM (SELECT DISTINCT vec_id FROM v)
), c0 AS MATERIALIZED (SELECT j, i, x AS y FROM v JOIN o USING (vec_id) WHERE j < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (
  SELECT vec_id, j, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM v JOIN c{r} USING (i) GROUP BY vec_id, j
), a{r} AS MATERIALIZED (
  SELECT vec_id, min_by(j, d * {k} + j) AS j, min(d) AS d FROM d{r} GROUP BY vec_id
)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
  SELECT j, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY j, i
), c{r + 1} AS MATERIALIZED (
  SELECT j, i, CASE WHEN n IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y FROM c{r} LEFT JOIN m{r} USING (j, i)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sign AS centroid_sha256
FROM a{rounds} JOIN (SELECT j, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS sign FROM c{rounds} GROUP BY j) USING (j)
"""


RESAMPLING_SQL = """
WITH w AS (
  SELECT TRUE AS own, doc_id, row_number() OVER () AS r, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT FALSE, NULL, 0, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), f AS MATERIALIZED (
  SELECT own, r, array_to_string(w[i:i + k], ' ') AS f, count(*) AS n FROM w, range(0, 3) AS s(k), unnest(range(1, len(w) + 1 - k)) AS t(i) GROUP BY ALL
), step AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) AS r(i))
), features AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)
), b AS MATERIALIZED (
  SELECT f, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % 10000 AS bucket
  FROM features, step
), counts AS (
  SELECT bucket, COALESCE(sum(n) FILTER (own), 0) AS s, COALESCE(sum(n) FILTER (NOT own), 0) AS t FROM f JOIN b USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * ((SELECT sum(s) FROM counts) + 10000) AS DOUBLE) / CAST((s + 1) * ((SELECT sum(t) FROM counts) + 10000) AS DOUBLE))) AS BIGINT) AS g FROM counts
), weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS g FROM f JOIN b USING (f) JOIN gains USING (bucket) WHERE own GROUP BY r
), scored AS (
  SELECT doc_id, len(w) AS words, COALESCE(n, 0) AS n_features, COALESCE(g, 0) AS weight,
    COALESCE(g, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN weights USING (r) WHERE own
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM scored WHERE words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= floor(5 * (SELECT count(*) FROM ranked) / 100) THEN k END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, COALESCE(html, '') AS h, strlen(COALESCE(html, '')) AS n, max(page_id) OVER (PARTITION BY COALESCE(html, '')) AS keeper FROM pages
)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_exact_topk_search": TOPK_SQL, "op9_substring_dedup": SUBSTRING_SQL, "op11_centroid_clustering": clusters_sql(),
        "op12_importance_resampling": RESAMPLING_SQL, "op13_warc": WARC_SQL,
    }
