"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import (
    decontaminate,
    hard_negatives,
    language,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    piece_codec,
    quality,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from meterline.llm.common import table
from meterline.sources.staging import scratch_path, stage

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE, with_ids=False)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language.fold("doc_id", 4) == 2
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).withColumn("held_out", held_out)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = language.fold("doc_id", 5) == 0
    return toxicity.score(docs, labels.where(~held_out)).withColumn("held_out", held_out)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents"))


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "archives")
    files = stage(warc.write_archives(pages, folder), "archive-files")
    return warc.page_records(warc.read_archives(files))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_duplicate_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines_dropped")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives.mine(table(spark, sf_dir, "embeddings"), label, F.col("id") % 50 == 0)
    return mined.drop("positive_rank")


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode(table(spark, sf_dir, "documents"), PIECES, with_ids=False)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whitened_table(table(spark, sf_dir, "embeddings"))
    # the operator's exact decimal; null where a table is so large that 64 bits cannot hold it
    return white.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_license": op5_license,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_piece_codec": op12_piece_codec,
    "op13_whitening": op13_whitening,
}

#: Base32 takes five bits a character: four characters from every five hexadecimal digits.
SQL: dict[str, str] = {
    "op7_warc": """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
  SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads
), named AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM digests
)
SELECT page_id,
  CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), i -> substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN top IS NULL OR page_id = top THEN NULL ELSE top END AS refers_to,
  true AS intact
FROM named
""",
    "op11_hard_negatives": """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), negatives AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
    PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
""",
}
