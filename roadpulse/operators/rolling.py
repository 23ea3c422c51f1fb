"""Rolling aggregates per key: every input row yields one output row.

Batch form. Rows of a key are ordered by ``order``; one hash shuffle on the key
(plus the chunk, for keys too large for one task, see ``hot_groups``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.operators.hot_groups import (
    MAX_GROUP_ROWS,
    carry_over,
    split_hot_groups,
    with_carry,
)

_AGGREGATE = {"min": F.min, "max": F.max, "sum": F.sum, "reduce": F.sum}
_COMBINE = {
    "min": F.least,
    "max": F.greatest,
    "sum": lambda a, b: F.coalesce(a + b, a, b),
    "reduce": lambda a, b: F.coalesce(a + b, a, b),
}
KINDS = tuple(_AGGREGATE)


def rolling(
    df: DataFrame,
    kind: str,
    order: Sequence[str] = ("ts", "seq"),
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Running aggregate of ``value`` per ``id``.

    ``min``, ``max`` and ``sum`` keep the ``ts`` of the key's first row;
    ``reduce`` (latest time, running sum) shows the ``ts`` of the current one.
    """
    if kind not in _AGGREGATE:
        raise ValueError(f"unknown kind {kind!r}, expected one of {KINDS}")
    out = _running(df, (kind,), order, max_group_rows)
    ts = F.col("ts") if kind == "reduce" else F.col("_ts")
    new = {"ts": ts.alias("ts"), "value": F.col(f"_{kind}").alias("value")}
    return out.select(*[new.get(c, F.col(c)) for c in df.columns])


def rolling_together(
    df: DataFrame,
    kinds: Sequence[str],
    order: Sequence[str] = ("ts", "seq"),
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """``(ts, id, seq)`` and a column per kind, all from one shuffle and one sort; ``ts`` is the
    key's first."""
    out = _running(df, tuple(kinds), order, max_group_rows)
    return out.select(F.col("_ts").alias("ts"), "id", "seq", *(F.col(f"_{k}").alias(k) for k in kinds))


def _running(df: DataFrame, kinds: tuple[str, ...], order: Sequence[str], max_group_rows) -> DataFrame:
    """``df`` with ``_ts``, the time of the key's first row, and ``_kind`` for each kind."""
    split = split_hot_groups(df, "id", order, max_group_rows)
    so_far = (
        Window.partitionBy(*split.keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = split.rows.withColumns({f"_{k}": _AGGREGATE[k]("value").over(so_far) for k in kinds})
    out = out.withColumn("_ts", F.first("ts").over(so_far))
    if split.is_split:
        carry = {f"_c_{k}": (_AGGREGATE[k]("value"), _AGGREGATE[k](f"_c_{k}")) for k in kinds}
        first = F.min_by(F.struct("ts"), F.struct(*order))  # a struct, as the time may be null
        carry["_c_ts"] = (first, F.first("_c_ts"))
        out = with_carry(out, split, carry_over(split, carry))
        carried = F.col("_c_ts")
        out = out.withColumns({f"_{k}": _COMBINE[k](F.col(f"_c_{k}"), F.col(f"_{k}")) for k in kinds})
        out = out.withColumn("_ts", F.when(carried.isNotNull(), carried["ts"]).otherwise(F.col("_ts")))
    return out


def running_count(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    name: str = "count",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Every row with the number (bigint) of rows of its key up to and including it."""
    split = split_hot_groups(df, key, order, max_group_rows)
    frame = Window.partitionBy(*split.keys).orderBy(*order)
    number = F.count("*").over(frame.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if not split.is_split:
        return split.rows.withColumn(name, number)
    carry = carry_over(split, {"_c_rows": (F.count("*"), F.sum("_c_rows"))})
    total = F.coalesce(F.col("_c_rows"), F.lit(0)) + F.col(name)
    numbered = with_carry(split.rows.withColumn(name, number), split, carry)
    return numbered.select(*df.columns, total.alias(name))
