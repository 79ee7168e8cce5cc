"""Corpus preparation in five stages; each reads what the one before has written.

Every stage takes and returns documents with all their columns, but the last, which returns their tokens. Texts that a
stage shortens have a matching ``n_chars`` where there is such a column.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, fm_index, ngram_join, quality, superkmers
from tallyloom.llm.common import staged
from tallyloom.session import release_staged, release_tables, staged_names, staged_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What the stage before has staged. Its result is written when the next stage begins, so nothing reads them any more.
_LEFT: list[str] = []


def _stage(function: Stage) -> Stage:
    """Release what the stage before has staged, then run the stage; results must be written before the next one is called."""

    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_tables(spark, _LEFT)
        _LEFT.clear()
        mark = staged_tables()
        result = function(spark, docs, sf_dir)
        _LEFT.extend(staged_names(mark))
        return result

    return run


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or are poor by trees fitted on the labels, go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return ngram_join.first_of_each_group(docs)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 20 words that start earlier in what is left are cut out; emptied documents stay, empty."""
    return superkmers.remove_repeats(docs)


@_stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that hold windows of ten words of the benchmark are cut out."""
    return fm_index.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts: ``doc_id, n_tokens, tokens``."""
    return bpe.token_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_passages),
    ("byte-level BPE", tokens),
]

#: The trees' verdicts and the token ids can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each result is written and read again, and only the last one stays."""
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), staged_tables()
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
        release_staged(spark, mark, staged_tables() - 1)
    return docs
