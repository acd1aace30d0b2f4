"""The corpus pipeline: documents to packed training sequences.

Four stages, each a call of one operator over all documents that the stage
before it kept.  All but the last return the columns of documents, so that a
stage's output, written as Parquet, is the next one's input.

1. quality_rules: documents that fail the current policy go.
2. toxicity: documents that the chain's last model finds toxic go; the
   models are fitted on the labels of documents that are still there.
3. ngram_jaccard: one document of each group of near copies stays.
4. packing: pieces of full training sequences.

Null texts read as empty and go with the short ones (stage 1), as do rows without words.
Rows without id are kept, one of each text; of repeated rows, and of texts that tie, the one
with the least id stays (stage 3).  Very long texts go through whole.  Stages keep other columns,
whatever their names, until the last.  An empty table gives no sequence; without labels nothing
is toxic.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from custmaster.llm import ngram_join, packing, quality, toxicity
from custmaster.llm.common import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_docs(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.filter_docs(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", near_copies_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The chain's fitted weights and the tokenizer have no SQL form; tests/llm/test_pipeline.py
#: holds the result against a brute-force version.
ORACLE_SQL = None
