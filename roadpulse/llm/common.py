"""Column expressions and staging shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.session import scratch_dir

# The six characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
PLACE_BITS = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(text: Column) -> Column:
    """The text; a null text is an empty one."""
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does the same where all is ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The runs of other characters than the six separators; none for a null text."""
    stripped = strip(whole_text(text))
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.split(stripped, SPACE_RUN)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, label)}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands Python ``rows`` rows at a time; the setting is put back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remainder(modulus: int) -> Column:
    """crc32 of the decimal ``doc_id`` modulo ``modulus``: which rows labels are learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def sampled(rows: DataFrame, most: int, seed: int, key: str = "doc_id") -> DataFrame:
    """At most ``most`` rows, all there are if fewer: the first in a random order of their keys.

    Places in that order fall into 4,096 ranges, which are counted first; only the ranges up
    to the one in which ``most`` rows are reached are put in order, so the one task that does
    it gets about ``most``. If that range is crowded, as when one key is repeated, its
    rows are thinned out at random to what is needed and six deviations of room.
    """
    place = F.xxhash64(key, F.lit(seed))
    at = F.shiftright(place, 64 - PLACE_BITS)
    counts = sorted(tuple(r) for r in rows.groupBy(at.alias("at")).count().collect())  # 4,096 rows
    before, last, inside = 0, None, 0
    for last, inside in counts:
        if before + inside >= most:
            break
        before += inside
    else:
        return rows
    need = most - before
    share = (need + 6 * need**0.5 + 10) / inside
    chance = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)) / 2.0**64 + 0.5
    crowded = inside > 2 * most + 1000
    kept = (at < last) | ((at == last) & (chance < share)) if crowded else at <= last
    return rows.where(kept).orderBy(place, key).limit(most)


def running_total(rows: DataFrame, order: Sequence[str | Column], amount: Column, name: str) -> DataFrame:
    """``rows``, staged, with ``name``: the sum of ``amount`` over all rows earlier in ``order``.

    Rows are dealt out by ranges of the order; ranges are summed apart and shifted by the
    totals of earlier ones, so no task sees all rows. Rows that are equal in ``order`` must
    be equal in ``amount`` or may be taken in any order.
    """
    spark = rows.sparkSession
    ranges = max(2, spark.sparkContext.defaultParallelism)
    parts = staged(
        rows.withColumn("_amount", amount)
        .repartitionByRange(ranges, *order)
        .withColumn("_part", F.spark_partition_id()),
        "ranges",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    totals = parts.groupBy("_part").agg(F.sum("_amount").alias("_total"))
    shifts = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_amount").over(within), F.lit(0)) + F.col("_shift")
    out = parts.join(shifts, "_part").withColumn(name, before.cast("long"))
    return staged(out.drop("_part", "_amount", "_shift"), "totals")


def cut_bytes(text: bytes, most: int) -> Iterator[bytes]:
    """A long text in pieces of about ``most`` bytes, cut at spaces only."""
    start = 0
    while len(text) - start > most:
        end = text.find(b" ", start + most)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:] if start else text
