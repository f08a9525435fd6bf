"""Registered queries of the operators, each over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wavemeld.llm import (bpe, chat, decontaminate, exact_dedup, html_extract, jaccard, lm, negatives, packing, repeats,
                          sharding, toxicity, variants)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    """The file of the byte-pair vocabulary, as ranks, and its pattern."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf, "documents"))


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf, "documents"), *vocabulary())


def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


def op7_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf, "pages"))


def op8_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op9_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    return chat.format_chats(table(spark, sf, "conversations"))


def op10_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score_documents(table(spark, sf, "documents"), *vocabulary())


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine_negatives(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


def op12_bpe_encoding(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trips(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.PATTERN)


def op13_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group_variants(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_suffix_dedup, op2_sharding, op3_packing, op4_toxicity, op5_exact_dedup, op6_ngram_jaccard, op7_html_extraction,
    op8_decontamination, op9_chat_formatting, op10_lm_scoring, op11_hard_negatives,
    op12_bpe_encoding, op13_spelling_variants)}

_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op5_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256
FROM d
""",
    "op9_chat_formatting": chat.ORACLE,
    "op11_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS anchor_row, a.vec_id AS anchor_id, b.r AS other_row, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_row ORDER BY score DESC, other_id, other_row) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_row, p.other_row ORDER BY n.score DESC, n.other_id, n.other_row)::INTEGER AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s AS n ON n.anchor_row = p.anchor_row AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
""",
}
