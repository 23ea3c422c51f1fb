"""Numbers of rows in an order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import staged


def number_rows(rows: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """``rows``, staged, with their number from 0 in ``order`` (columns that tell rows apart).

    Rows are dealt out by ranges of the order; each range is numbered apart and shifted by
    the sizes of those before it.
    """
    ranges = max(2, rows.sparkSession.sparkContext.defaultParallelism)
    parts = staged(rows.repartitionByRange(ranges, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    shifts = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = parts.withColumn("_within", within).join(F.broadcast(shifts), "_part")
    number = (F.col("_within") + F.col("_shift")).cast("long")
    return staged(numbered.withColumn(name, number).drop("_part", "_within", "_shift"), "numbered")
