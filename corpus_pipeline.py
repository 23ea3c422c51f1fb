"""A corpus made ready for training: five stages, each written as Parquet and read again.

1. quality_rules: documents that fail the policy go.
2. line_dedup: lines that an earlier document holds go; the texts shrink.
3. near_dedup: of each group of near-duplicates the document with the smallest id stays.
4. mixing: documents come as often as the mix takes them, possibly not at all.
5. sentence_pieces: the token ids of each document, in a column ``ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm import line_dedup, mixing, near_dedup, quality_rules, sentence_pieces
from roadpulse.llm.common import staged

# Words in a shingle of near_dedup: pairs, as in op5_near_dedup, so that both give the same groups.
NEAR_WIDTH = 2


def _quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.rejected_go(docs)


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, NEAR_WIDTH)


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def _sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_pieces.encoded(docs)


STAGES = [
    ("quality_rules", _quality_rules),
    ("line_dedup", _line_dedup),
    ("near_dedup", _near_dedup),
    ("mixing", _mixing),
    ("sentence_pieces", _sentence_pieces),
]

# The last stage's token ids are not expressible in SQL; the tests hold the stages against
# a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
