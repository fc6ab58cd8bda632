"""Queries of the corpus operators over the supplied tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    exact, language, lines, mixing, near, negatives, parity, personal, pieces, quality, substrings,
    toxicity, whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_words(_table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_verdicts(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal.personal_spans(_table(spark, folder, "documents"))


def op5_repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_repeated_lines(_table(spark, folder, "documents"))


def op6_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.drop_repeated_substrings(_table(spark, folder, "documents"))


def op7_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(_table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_copies(_table(spark, folder, "documents"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_groups(_table(spark, folder, "documents"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(_table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(_table(spark, folder, "embeddings"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    anchors = rows.where("vec_id % 100 = 0").select("vec_id")
    return negatives.hard_negatives(rows.withColumn("label", moved), anchors)


def op13_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity.jaccard_groups(_table(spark, folder, "documents"))


QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_personal_data": op4_personal_data,
    "op5_repeated_lines": op5_repeated_lines,
    "op6_repeated_substrings": op6_repeated_substrings,
    "op7_pieces": op7_pieces,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_language": op10_language,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_jaccard_join": op13_jaccard_join,
    "pipeline": corpus_pipeline.run,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINES = r"""
        WITH lines AS (
          SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
        keyed AS (
          SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words,
                 sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY place) - length(line) - 1 AS start
          FROM lines),
        ranked AS (
          SELECT *, len(words) >= 5 AS counts,
                 len(words) >= 5 AND row_number() OVER (
                   PARTITION BY array_to_string(words, ' ') ORDER BY doc_id, place) > 1 AS gone
          FROM keyed)
        SELECT doc_id, count(*) FILTER (counts) AS n_units, count(*) FILTER (gone) AS n_removed,
               CAST(coalesce(sum(length(line)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
               coalesce(string_agg(start || ':' || (start + length(line)), ',' ORDER BY place)
                 FILTER (gone), '') AS spans,
               coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
        FROM ranked GROUP BY doc_id
    """

_NEGATIVES = """
        WITH whole AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda c: floor(CAST(c AS DOUBLE) * 256)) AS x
          FROM embeddings
          WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                 CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
          FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
        SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT same
          AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """

ORACLE_SQL = {
    "op12_hard_negatives": _NEGATIVES,
    "op5_repeated_lines": _LINES,
    "op8_exact_dedup": f"""
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same
                   AND row_number() OVER (PARTITION BY lowered, doc_id) = 1 AS kept,
               sha256(lowered) AS text_sha256
        FROM (SELECT doc_id, {_LOWERED} AS lowered FROM documents)
        WINDOW same AS (PARTITION BY lowered)
    """,
}
