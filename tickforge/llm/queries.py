"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickforge.llm import (bpe, decontam, html_text, langid, licenses, merkle, mixing, periodic_runs, simhash, suffix_dedup,
                           token_counts, topk, warc)
from tickforge.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the ten best of every hundredth vector."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe.digests(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    return langid.predictions(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, text (what is left) of every document."""
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"), length=400)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, window_start, window_words, similarity of every document that holds a benchmark item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page."""
    path = scratch_path(spark, f"llm-warc-{uuid.uuid4().hex}")
    return warc.round_trip(table(spark, sf_dir, "pages"), path)


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, radius=3)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the strongest run, runs_sha256, collapsed_sha256 of every document."""
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    return merkle.verified(table(spark, sf_dir, "documents"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_exact_top_k, op3_byte_bpe, op4_language_id, op5_license_scan,
    op6_suffix_dedup, op7_html_text, op8_decontamination, op9_warc, op10_simhash_near_dedup, op11_periodic_runs,
    op12_merkle_manifest, op13_source_mixing)}

ORACLE = {
    "op5_license_scan": licenses.oracle(),
    "op8_decontamination": decontam.oracle(),
    "op12_merkle_manifest": merkle.oracle(),
    "op13_source_mixing": mixing.oracle(),
    "op2_exact_top_k": """
        WITH sound AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        parts AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM sound),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
            FROM parts q JOIN parts c ON c.i = q.i AND c.vec_id <> q.vec_id
            WHERE q.vec_id % 100 = 0 GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op9_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (
            SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS hex,
                   min(page_id) OVER (PARTITION BY sha1(body)) AS first FROM p)
        SELECT page_id, payload_bytes,
               list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(hex, 1 + 10 * (k // 8)::INT, 10))::BIGINT
                         >> (35 - 5 * (k % 8))::INT) & 31)::INT, 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM d""",
}
