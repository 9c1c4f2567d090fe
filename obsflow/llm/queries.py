"""Registered queries of this subpackage: each applies one operator to its
whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    cap_filters,
    context_tree,
    hard_negatives,
    imatch,
    language_id,
    line_dedup,
    near_dedup,
    packing,
    pieces,
    sanitise,
    sharding,
    spelling,
    token_counts,
)
from .common import PIECE_BPE_FILE, WORD_BPE_FILE, table, tokenizer_path


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE_FILE))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding gives the text back."""
    return pieces.encoded_documents(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_BPE_FILE))


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings of a label."""
    return cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight k-d tree leaves of nearly equal bytes."""
    return sharding.document_shards(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text, as the library counts them."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE_FILE))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines they repeat from earlier ones."""
    return line_dedup.deduplicated_documents(table(spark, sf_dir, "documents"))


def op8_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, in every whole text."""
    return sanitise.personal_data(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from the rows not held out."""
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text."""
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of all embeddings, some labels moved."""
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=hard_negatives.shifted_label())


def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text scored by a model of the texts not held out."""
    return context_tree.scored_documents(table(spark, sf_dir, "documents"))


def op13_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the frequent words of all texts."""
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_sentencepiece,
        op3_minhash_forest,
        op4_cap_filters,
        op5_kd_shards,
        op6_token_counts,
        op7_line_dedup,
        op8_sanitise,
        op9_language_id,
        op10_imatch_fingerprints,
        op11_segment_negatives,
        op12_context_tree,
        op13_pivotal_spelling,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op11_segment_negatives": """
        WITH e AS (
            SELECT vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                   CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), p AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score
            FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
               s.other_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 3
    """,
}
