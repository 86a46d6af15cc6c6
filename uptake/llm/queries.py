"""The operators' queries over whole tables, and SQL that checks them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm import (
    fingerprints,
    html,
    mixing,
    mtree,
    near,
    oracles,
    packing,
    quoting,
    repair,
    resampling,
    secrets,
    substrings,
    suffixes,
    toxicity,
)
from uptake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    originals = table(spark, sf_dir, "conversations")
    return repair.audit(repair.damaged(originals), originals)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Query] = {
    "op1_quotations": lambda spark, sf_dir: quoting.reply_order(table(spark, sf_dir, "conversations")),
    "op2_fingerprints": _documents(lambda docs: fingerprints.with_neighbours(fingerprints.fingerprint_edits(docs))),
    "op3_substring_dedup": _documents(lambda docs: substrings.remove_repeats(docs, digest=True)),
    "op4_main_text": lambda spark, sf_dir: html.extract(table(spark, sf_dir, "pages")),
    "op5_toxicity": lambda spark, sf_dir: toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op6_packing": _documents(packing.packed),
    "op7_top_k": op7_top_k,
    "op8_near_dedup": _documents(near.near_components),
    "op9_mixing": _documents(mixing.mixture),
    "op10_secrets": _documents(secrets.scan),
    "op11_suffix_dedup": _documents(lambda docs: suffixes.remove_repeats(docs, digest=True)),
    "op12_conversation_repair": op12_conversation_repair,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES: dict[str, str] = oracles.ORACLES | {
    "op3_substring_dedup": r"""
        WITH lists AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents
        ), words AS (
            SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos,
                   unnest(list_transform(range(1, len(w) + 1),
                       lambda i: CASE WHEN i + 19 <= len(w) THEN md5(array_to_string(w[i:i + 19], ' ')) END)) AS window_key
            FROM lists
        ), firsts AS (
            SELECT window_key, min(row(doc_id, pos)) AS place FROM words WHERE window_key IS NOT NULL GROUP BY window_key
        ), marked AS (
            SELECT doc_id, pos, word, coalesce(row(doc_id, pos) > place, false) AS late FROM words LEFT JOIN firsts USING (window_key)
        ), judged AS (
            SELECT doc_id, pos, word,
                   bool_or(late) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
            FROM marked
        ), sums AS (
            SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone) AS kept
            FROM judged GROUP BY doc_id
        )
        SELECT l.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM lists l LEFT JOIN sums USING (doc_id)
    """,
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5(concat(coalesce(doc_id::VARCHAR, ''), '#', coalesce(text, ''))) AS k
            FROM documents
        ), sums AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight,
                   row_number() OVER (ORDER BY source COLLATE C NULLS LAST) AS number
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, (sum(source_size) OVER ()::BIGINT - 3 * coalesce(sum(source_size) OVER before, 0)::BIGINT)
                      / sum(weight) OVER after::BIGINT AS level
            FROM sums
            WINDOW before AS (ORDER BY source_size / weight, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                   after AS (ORDER BY source_size / weight, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
        ), chosen AS (
            SELECT first(level ORDER BY source_size / weight, number) AS level, min(source_size / weight) AS least
            FROM levels WHERE weight * level <= 3 * source_size
        ), goals AS (
            SELECT source, source_size, CASE WHEN source_size / weight < least THEN 3.0::DOUBLE * source_size
                   ELSE least(weight * chosen.level, 3.0::DOUBLE * source_size) END AS target
            FROM sums, chosen
        ), placed AS (
            SELECT s.doc_id, s.size, g.source_size, g.target,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
                   CASE WHEN g.source_size > 0 THEN floor(g.target)::BIGINT // g.source_size ELSE 0 END AS passes
            FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size, source_size, target,
               (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - before)))::BIGINT AS taken
        FROM placed
    """,
}
