"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mediapanel.llm import (
    bpe, chat_format, decontaminate, html_extract, langid, near_dedup, pii, sharding, substring_dedup, topk, toxicity,
    va_cluster, whitening)
from mediapanel.llm.common import table


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, with_text=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), vocabulary_path(), outputs=())


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k_of_embeddings(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", marks), (-7, 1, "assistant", marks)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_format.digests(chat_format.format_conversations(rows))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_va_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_cluster.clustered_embeddings(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_bpe": op4_bpe,
    "op5_topk": op5_topk,
    "op6_pii": op6_pii,
    "op7_html": op7_html,
    "op8_sharding": op8_sharding,
    "op9_near_dedup": op9_near_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_chat_format": op11_chat_format,
    "op12_whitening": op12_whitening,
    "op13_va_cluster": op13_va_cluster,
}


def _clusters_sql(k: int = va_cluster.CENTROIDS, rounds: int = va_cluster.ROUNDS, seed: int = va_cluster.SEED,
                  dims: int = va_cluster.DIMS) -> str:
    """The rounds one after another, by plain distances."""
    parts = [f"""
e AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE len(embedding) = {dims} AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1)::INT AS cluster, v
  FROM e QUALIFY cluster < {k}
)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT e.row, c.cluster, (list_dot_product(e.v, e.v) - 2 * list_dot_product(e.v, c.v) + list_dot_product(c.v, c.v))::BIGINT AS distance
  FROM e CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY e.row ORDER BY distance, c.cluster) = 1
)""")
        if r < rounds:
            parts.append(f"""s{r} AS MATERIALIZED (
  SELECT cluster, d, floor(sum(x) / count(*)) AS x
  FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS d FROM a{r} JOIN e USING (row)) GROUP BY cluster, d
), c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.v, c.v) AS v
  FROM c{r} c LEFT JOIN (SELECT cluster, list(x ORDER BY d) AS v FROM s{r} GROUP BY cluster) n USING (cluster)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(list_transform(c.v, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',')) AS centroid_sha256
FROM a{rounds} JOIN e USING (row) JOIN c{rounds} c USING (cluster)"""


ORACLE: dict[str, str] = {
    "op5_topk": """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
""",
    "op11_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c
), x AS (
  SELECT *, regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'),
                           '\[(\\*(?:/?INST|ASST|/?SYS|ROLE|/?TEXT|NEXT)\])', '[\\\1', 'g') AS safe,
         regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'),
                        '\[(\\*(?:/?INST|ASST|/?SYS|ROLE|/?TEXT|NEXT)\])', '[\\\1', 'g') AS safe_role
  FROM t
), y AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS opens
  FROM x WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, safe_role, safe)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, safe_role, safe)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, safe_role, safe) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(length(safe) + CASE
          WHEN NOT opens THEN length('[NEXT]')
          WHEN role = 'user' THEN length('[INST][/INST]')
          WHEN role = 'assistant' THEN length('[ASST]</s>')
          WHEN role = 'system' THEN length('[SYS][/SYS]')
          ELSE length('[ROLE][TEXT][/TEXT]') + length(safe_role) END))::BIGINT AS formatted_chars
FROM y GROUP BY conv_id
""",
    "op13_va_cluster": _clusters_sql(),
}
