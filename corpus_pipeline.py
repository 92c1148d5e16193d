"""A training corpus from documents: quality rules, exact and near duplicates, packing.

Each stage takes what its predecessor kept, as Parquet that was written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm.exact_dedup import keep_first
from ledgerspark.llm.ngram_join import keep_one_of_each
from ledgerspark.llm.packing import pack_documents
from ledgerspark.llm.quality_rules import clean_documents
from ledgerspark.session import recorded_scratch, remove_scratch, scratch_path


# Scratch tables of the stage before; its result is written when the next stage begins.
_SCRATCH: list[str] = []


def _stage(spark: SparkSession, operator: Callable[[], DataFrame]) -> DataFrame:
    """Remove what the stage before has left, then run the operator."""
    remove_scratch(spark, _SCRATCH)
    with recorded_scratch() as made:
        result = operator()
    _SCRATCH.extend(made)
    return result


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return _stage(spark, lambda: clean_documents(docs))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    return _stage(spark, lambda: keep_first(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return _stage(spark, lambda: keep_one_of_each(docs, words=5, percent=80))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 2048."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return _stage(spark, lambda: pack_documents(docs, tokenizer))


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact_duplicates),
    ("ngram_join", near_duplicates),
    ("packing", packing),
]

# Packing works on subword ids, which SQL cannot make.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
