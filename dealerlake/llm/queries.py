"""Each operator over its whole table, with production parameters; and the same results in SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake.llm import (
    collocations,
    decontaminate,
    hash_search,
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    line_quality,
    merkle,
    personal_data,
    secrets,
    sentence_pieces,
    warc,
)
from dealerlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_search.search_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.detect_languages(table(spark, sf_dir, "documents"))


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def benchmark_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def shingle_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.groups(table(spark, sf_dir, "documents"), jaccard_join.Similarity(words=3, percent=90))


def piece_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.report(table(spark, sf_dir, "documents"))


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def page_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def personal_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.scan_personal_data(table(spark, sf_dir, "documents"))


def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def license_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {
        "op1_multi_index_hashing": nearest_vectors,
        "op2_language_id": document_languages,
        "op3_quality_classifier": document_quality,
        "op4_benchmark_decontamination": benchmark_overlap,
        "op5_ngram_jaccard_join": shingle_components,
        "op6_sentencepiece": piece_tokens,
        "op7_secret_scan": secret_spans,
        "op8_warc": page_archives,
        "op9_line_dedup": repeated_lines,
        "op10_pii": personal_spans,
        "op11_merkle_manifest": document_manifest,
        "op12_phrase_collocations": phrase_collocations,
        "op13_license_scan": license_labels,
        "pipeline": corpus_pipeline.run,
    }


OVERLAP_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), starts AS (
  SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM item_words WHERE len(words) > 0
), item_windows AS (
  SELECT DISTINCT item_id, words[pos:pos + 9] AS run FROM starts
), sizes AS (
  SELECT DISTINCT len(run) AS size FROM item_windows
), runs AS (
  SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM doc_words, sizes
), found AS (
  SELECT doc_id, pos, size, item_id FROM runs JOIN item_windows ON run = words[pos:pos + size - 1]
), hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM (SELECT DISTINCT doc_id, pos, size FROM found)) GROUP BY doc_id
), held AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN held USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """The other operators learn or walk graphs; tests hold them against brute force and held-out rows."""
    return {
        "op4_benchmark_decontamination": OVERLAP_SQL,
        "op8_warc": warc.ORACLE_SQL,
        "op9_line_dedup": line_dedup.ORACLE_SQL,
        "op11_merkle_manifest": merkle.ORACLE_SQL,
        "op12_phrase_collocations": collocations.ORACLE_SQL,
        "op13_license_scan": licenses.ORACLE_SQL,
    }
