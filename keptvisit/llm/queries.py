"""Registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keptvisit.llm import (
    ann,
    interpolation,
    jaccard,
    mixing,
    neardup,
    negatives,
    pages,
    passages,
    pieces,
    prefixes,
    quality,
    secrets,
    toxicity,
)

PIECES_FILE = "piece_bpe_32k.model"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(secrets.scan(read(spark, folder, "documents")))


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.find(read(spark, folder, "embeddings"))


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.report(passages.repeats(read(spark, folder, "documents")))


def op4_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(read(spark, folder, "documents"))


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(read(spark, folder, "embeddings"), F.col("id") % 20 == 0)


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = pieces.encode(
        read(spark, folder, "documents"), public_tokenizers.path(PIECES_FILE))
    return pieces.digests(encoded)


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return interpolation.score(*interpolation.train(read(spark, folder, "documents")))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(read(spark, folder, "pages"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixes.trie(read(spark, folder, "conversations"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(read(spark, folder, "embeddings"))


QUERIES = {run.__name__: run for run in (
    op1_secret_scan, op2_embedding_near_dedup, op3_substring_dedup, op4_source_mixing,
    op5_ngram_jaccard_join, op6_nearest_neighbours, op7_quality_classifier, op8_sentencepiece,
    op9_lm_scoring, op10_html_extraction, op11_toxicity, op12_conversation_trie,
    op13_hard_negatives,
)}

ORACLES = {
    "op1_secret_scan": secrets.oracle(),
    "op4_source_mixing": mixing.oracle(),
    "op12_conversation_trie": prefixes.oracle(),
    "op13_hard_negatives": negatives.oracle(),
}
