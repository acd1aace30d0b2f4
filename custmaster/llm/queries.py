"""Registered queries of the corpus operators: one ``opN_<name>`` each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from custmaster.llm import (bpe, centroids, chat, cover_tree, fingerprints, kneser_ney, lattice, licenses, ngram_join, packing,
                            quality, toxicity, warc)
from custmaster.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"),
                      public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.digest(table(spark, sf_dir, "documents"), kneser_ney.ORDER)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.run(spark, sf_dir)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.digest(table(spark, sf_dir, "embeddings"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(table(spark, sf_dir, "embeddings"))


def op13_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc": op6_warc,
    "op7_chat_format": op7_chat_format,
    "op8_fingerprints": op8_fingerprints,
    "op9_licenses": op9_licenses,
    "op10_packing": op10_packing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_centroids": op12_centroids,
    "op13_lattice_dedup": op13_lattice_dedup,
}

ORACLES: dict[str, str] = {
    "op4_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op5_quality_rules": quality.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op11_hard_negatives": cover_tree.ORACLE_SQL,
    "op12_centroids": centroids.ORACLE_SQL,
    "op13_lattice_dedup": lattice.ORACLE_SQL,
}
