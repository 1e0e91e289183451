"""A training-data pipeline over ``documents``: each stage applies one operator
of ``hearth.llm`` to everything its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hearth.llm import bpe, decontam, line_dedup, ngram_join, quality
from hearth.llm.queries import RANKS
from hearth.llm.tables import saved
from hearth.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go; every document stays, a text of
    which nothing is left as an empty one."""
    return line_dedup.drop_matched_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    return ngram_join.keep_one_of_group(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids, packed, with their number and digests."""
    return bpe.round_trip_digest(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids_col="ids")


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", token_stage),
]

#: The quality stage's expectation-maximisation has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage{i}")
    return docs
