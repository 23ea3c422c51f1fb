"""Row-wise operators: filters, projections, fan-out. Batch and stream alike.

All of them are plain expressions in the scan stage; no shuffle, and comparisons
on stored columns reach the Parquet reader as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Segments at which the averaged section starts and ends, and the
# expressways whose middle segments the compact preset ignores.
SECTION_FIRST, SECTION_LAST = 52, 56
QUIET_XWAYS = (0, 4)


def above(df: DataFrame, threshold: float = 20, value: str = "value") -> DataFrame:
    """Readings strictly above the threshold."""
    return df.where(F.col(value) > threshold)


def speeding(df: DataFrame, limit: int = 90) -> DataFrame:
    return df.where(F.col("spd") > limit)


def stopped(df: DataFrame) -> DataFrame:
    return df.where(F.col("spd") == 0)


def in_section(df: DataFrame) -> DataFrame:
    return df.where(_section())


def in_section_skipping_quiet_middle(df: DataFrame) -> DataFrame:
    """As ``in_section``, but middle segments of quiet expressways are dropped.

    Not a mere optimisation: dropping reports may split a session.
    """
    ends = F.col("seg").isin(SECTION_FIRST, SECTION_LAST)
    return df.where(_section() & (ends | ~F.col("xway").isin(*QUIET_XWAYS)))


def _section() -> Column:
    return F.col("seg").between(SECTION_FIRST, SECTION_LAST)


def fan_out(
    df: DataFrame,
    key: str = "sensor1",
    constant: float = 1.0,
    label: str = "this is a string test",
    label_value: float = 134.0,
) -> DataFrame:
    """Three rows per reading of one sensor, none for the others.

    The reading itself, the reading with a constant value, and a labelled row.
    Columns beyond ``(ts, id, value)`` are carried along unchanged.
    """
    others = [c for c in df.columns if c not in ("ts", "id", "value")]
    rows = F.array(
        F.struct("ts", "id", "value"),
        F.struct("ts", "id", F.lit(float(constant)).alias("value")),
        F.struct("ts", F.lit(label).alias("id"), F.lit(float(label_value)).alias("value")),
    )
    return df.where(F.col("id") == key).select(F.inline(rows), *others)
