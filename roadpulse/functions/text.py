"""Tokenising and counting of words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.hot_groups import MAX_GROUP_ROWS
from roadpulse.operators.rolling import running_count

# Fixed value: what separates words (ASCII letters, digits and _ make up words).
SEPARATOR = r"\W+"


def _pieces(value: str) -> Column:
    return F.split(F.lower(F.col(value)), SEPARATOR)


def tokens(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row ``word`` per token: lower case, empty pieces dropped."""
    return lines.select(F.explode(_pieces(value)).alias("word")).where(F.col("word") != "")


def numbered_tokens(
    lines: DataFrame, value: str = "value", seq: str = "seq", also: Sequence[str] = ()
) -> DataFrame:
    """``(seq, pos, word)``: tokens with their line and their place in it, and columns of the line."""
    pieces = F.posexplode(_pieces(value)).alias("pos", "word")
    return lines.select(seq, pieces, *also).where(F.col("word") != "")


def word_count(lines: DataFrame, value: str = "value") -> DataFrame:
    """``(word, count)``. Counts are combined before the shuffle, so a frequent
    word costs one row per task. On a stream: the running total per word."""
    return tokens(lines, value).groupBy("word").agg(F.count("*").alias("count"))


def running_word_count(
    lines: DataFrame, value: str = "value", seq: str = "seq",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``(seq, pos, word, count)``: one row per token, how often its word was seen so far."""
    numbered = numbered_tokens(lines, value, seq)
    return running_count(numbered, "word", (seq, "pos"), "count", max_group_rows)
