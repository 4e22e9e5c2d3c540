"""From raw documents to packed sequences: without toxic documents, copies and near copies.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import exact_dedup, near_dedup, packing, toxicity
from eventlake.llm.common import remove, table, tables_made, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a toxicity of 0.5 or more; what is toxic is learned from the labels table."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more of their five-word shingles, the smallest doc_id stays."""
    return near_dedup.keep_one(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 4096 tokens at most, with their places in sequences of 4096."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", without_toxic), ("exact_dedup", without_copies), ("near_dedup", without_near_copies), ("packing", packed)]

#: No SQL: a trained classifier and a tokenizer decide. tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in a row, each one's documents written and read again; what a stage has read goes once its own documents are written."""
    docs, spent = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with tables_made() as made:
            docs = written(stage(spark, docs, sf_dir), name)
        for df in spent + made[:-1]:
            remove(df)
        spent = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
