"""From raw documents to packed training sequences, one operator after the other.

Each stage takes (spark, docs, sf_dir). What it returns is saved and read again as the next
one's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsemart.llm import decontaminate, ngram_join, packing, quality_rules, repeats
from pulsemart.llm.common import saved, table

SEQUENCE = 2048


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 400-byte strings that start more than once."""
    return repeats.cut(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids, sequence and place in it."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.cut(docs, tokenizer, end=0, size=SEQUENCE, with_ids=True)
    return packing.pack(pieces, SEQUENCE)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", repeated_strings),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages hash, cluster and encode; tests hold each against a plain version instead.
ORACLE_SQL = None
