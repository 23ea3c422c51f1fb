"""Splitting of keys that hold too many rows for one task.

An ordered, per-key computation (a running sum, a row frame, a session) puts all
rows of a key into one task. That is right for ordinary keys, but one vehicle,
sensor or word may hold a third of the data. Such keys are cut into *chunks*:
ranges of the key's own order of at most ``max_group_rows`` rows. Each operator
then works per ``(key, chunk)`` and adds what the preceding chunks of that key
hand over.

How keys are cut: one map-side-combined count per key names the hot ones, in a table
in the shared folder. Their rows alone are dealt out by ranges of (key, order), sorted
within a range, numbered, and written with the chunk as a column. There may be any
number of hot keys and chunks; the driver holds neither. A chunk is written data, so a
lost task sees the same chunks again. The null key is a key like others.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.session import staged

CHUNK = "_chunk"

# A key with more rows than this is cut.
MAX_GROUP_ROWS = 4_000_000
# monotonically_increasing_id: the partition above, the row within it in these bits.
_ROW_BITS = 33


@dataclass(frozen=True)
class Split:
    """Rows with their chunk (0: the key is whole). ``keys`` are the columns to group by."""

    rows: DataFrame
    key: str
    order: tuple[str, ...]
    hot: DataFrame | None = None

    @property
    def is_split(self) -> bool:
        return self.hot is not None

    @property
    def keys(self) -> list[str]:
        return [self.key, CHUNK] if self.is_split else [self.key]

    @property
    def is_hot(self) -> Column:
        """Whether a row's key was cut."""
        return F.col(CHUNK) > 0


@dataclass(frozen=True)
class KeySizes:
    """Rows per key (``key, _n``), kept until ``split_hot_groups`` has taken the hot keys from them,
    the most and the mean of them."""

    per_key: DataFrame
    largest: int
    mean: float


def key_sizes(df: DataFrame, key: str) -> KeySizes:
    per_key = df.groupBy(key).agg(F.count("*").alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        largest, mean = per_key.agg(F.max("_n"), F.avg("_n")).first()
    except Exception:
        per_key.unpersist()
        raise
    return KeySizes(per_key, largest or 0, mean or 0.0)


def hot_apart(
    df: DataFrame, key: str, order: Sequence[str], max_group_rows: int | None, sizes: KeySizes | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """The rows of ordinary keys and those of keys with more than ``max_group_rows`` rows, the latter
    in ranges of (key, order) and sorted; None if no key has that many."""
    if max_group_rows is None:
        return None
    sizes = sizes or key_sizes(df, key)
    try:
        if sizes.largest <= max_group_rows:
            return None
        is_hot = F.col("_n") > max_group_rows
        keys = staged(sizes.per_key.where(is_hot).select(F.col(key).alias("_hot")), "hot-keys")
    finally:
        sizes.per_key.unpersist()
    same = df[key].eqNullSafe(keys["_hot"])
    hot = df.join(keys, same, "left_semi").repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    return df.join(keys, same, "left_anti"), hot


def split_hot_groups(
    df: DataFrame, key: str, order: Sequence[str], max_group_rows: int | None = MAX_GROUP_ROWS,
    sizes: KeySizes | None = None,
) -> Split:
    """Cut the keys of ``df`` that hold more than ``max_group_rows`` rows.

    ``order`` lists columns that put a key's rows into a total order.
    ``max_group_rows=None`` promises that no key is large and skips the count. ``sizes`` are
    given where they are known or ``df`` holds its rows summed up.
    """
    order = tuple(order)
    apart = hot_apart(df, key, order, max_group_rows, sizes)
    if apart is None:
        return Split(df, key, order)
    cold, hot = apart
    number = F.monotonically_increasing_id()
    partition = F.shiftright(number, _ROW_BITS)
    row = number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    chunk = F.shiftleft(partition, _ROW_BITS) + F.floor(row / max_group_rows) + 1
    hot = staged(hot.withColumn(CHUNK, chunk), "hot-rows")
    cold = cold.withColumn(CHUNK, F.lit(0).cast("long"))
    return Split(cold.unionByName(hot), key, order, hot)


def carry_over(split: Split, aggregates: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per chunk of a hot key, what all *earlier* chunks of that key add up to: a row
    ``(_c_key, _c_chunk, ...)`` per key and chunk.

    ``aggregates`` maps a name to (aggregate within a chunk, aggregate of the
    chunk results).
    """
    earlier = (
        Window.partitionBy(split.key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    within = split.hot.groupBy(*split.keys).agg(*[a.alias(n) for n, (a, _) in aggregates.items()])
    return within.select(
        F.col(split.key).alias("_c_key"), F.col(CHUNK).alias("_c_chunk"),
        *[m.over(earlier).alias(n) for n, (_, m) in aggregates.items()],
    )


def with_carry(rows: DataFrame, split: Split, carry: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``carry_over`` has for their key and chunk."""
    same = rows[split.key].eqNullSafe(carry["_c_key"]) & (rows[CHUNK] == carry["_c_chunk"])
    return rows.join(carry, same, "left")
