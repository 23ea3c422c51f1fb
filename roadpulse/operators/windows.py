"""Sliding time windows, sessions and sliding count windows per key."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.hot_groups import (
    CHUNK,
    MAX_GROUP_ROWS,
    hot_apart,
    key_sizes,
    split_hot_groups,
)
from roadpulse.session import staged

_MERGE = {"min": F.min, "max": F.max, "sum": F.sum}
# Panes of a window up to which each pane is spread over its windows; only cost depends on it.
MOST_SPREAD = 16
# Rows per key from which sessions are made of sums; only cost depends on it.
ROWS_TO_SUM = 8


def sliding_sum(
    df: DataFrame, size: int = 3, slide: int = 1, panes: bool | None = None
) -> DataFrame:
    """``(window_start, ts, id, value)`` per id and window of ``size`` seconds.

    ``value`` is the sum over the window and ``ts`` its last reading's time
    (epoch seconds, like ``window_start``). Windows start at multiples of
    ``slide`` and exist only where they hold a reading.

    Sum and maximum are combined before the shuffle, so a busy id is no hot spot.
    ``panes`` sums per slide first; it needs slides that fill a window evenly and is the
    default for tables where they do. Tables then go from panes to windows in one of two
    ways that give the same: each pane's sum is spread over its windows, or, where that
    would be many, windows are put together from running sums, see ``_windows_from_blocks``.

    A stream by default puts each reading into its windows; the watermark closes them. With
    ``panes`` the state holds a reading once, in its pane, and the windows of closed panes: the
    form for wide windows. A reading behind the watermark whose pane is closed then is in
    no window, while the default still adds it to those of its windows that are open.
    """
    if panes is None:
        panes = not df.isStreaming and size % slide == 0
    if panes and size % slide:
        raise ValueError("panes need a window size that is a multiple of the slide")
    if df.isStreaming:
        return _stream_sliding_sum(df, size, slide, panes)
    if panes:
        spread = size // slide <= MOST_SPREAD
        return (_windows_by_spreading if spread else _windows_from_blocks)(_panes(df, slide), size, slide)
    window = F.window(F.timestamp_seconds("ts"), f"{size} seconds", f"{slide} seconds")
    return _named(df.groupBy("id", window.alias("_w")).agg(*_totals()))


def _totals() -> tuple[Column, Column]:
    return F.max("ts").alias("ts"), F.sum("value").alias("value")


def _named(windows: DataFrame) -> DataFrame:
    return windows.select(F.unix_seconds("_w.start").alias("window_start"), "ts", "id", "value")


def _stream_sliding_sum(df: DataFrame, size: int, slide: int, panes: bool) -> DataFrame:
    window = lambda time: F.window(time, f"{size} seconds", f"{slide} seconds").alias("_w")
    if not panes:
        return _named(df.groupBy("id", window("event_time")).agg(*_totals()))
    pane = F.window("event_time", f"{slide} seconds").alias("_pane")
    sums = df.groupBy("id", pane).agg(*_totals())
    return _named(sums.groupBy("id", window(F.window_time("_pane"))).agg(*_totals()))


def _panes(df: DataFrame, slide: int) -> DataFrame:
    """``(id, _pane, ts, value)``; panes are numbered by time in units of the slide."""
    return df.groupBy("id", F.floor(F.col("ts") / slide).alias("_pane")).agg(*_totals())


def _windows_by_spreading(panes: DataFrame, size: int, slide: int) -> DataFrame:
    offsets = F.sequence(F.lit(0), F.lit(size // slide - 1))
    return (
        panes.withColumn("_offset", F.explode(offsets))
        .groupBy("id", ((F.col("_pane") - F.col("_offset")) * slide).alias("window_start"))
        .agg(*_totals())
        .select("window_start", "ts", "id", "value")
    )


def _windows_from_blocks(panes: DataFrame, size: int, slide: int) -> DataFrame:
    """Windows put together from two running sums, neither of which is ever subtracted from.

    Panes lie in blocks of as many as a window has. A window that starts at place x of a block
    holds the block's panes from x on and the next block's panes before x: the sum from
    the end of the one, and from the start of the other. Between two places at which either sum
    changes all windows are equal, so rows are made per change, at most three for a pane, and
    windows only for what is returned.
    """
    per_block = size // slide
    block = F.floor(F.col("_pane") / per_block)
    placed = panes.select("id", block.alias("_block"), (F.col("_pane") - block * per_block).alias("_at"), "ts", "value")
    own = Window.partitionBy("id", "_block")
    so_far = own.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_here = own.orderBy("_at").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sums = lambda frame: F.struct(F.max("ts").over(frame).alias("ts"), F.sum("value").over(frame).alias("value"))
    running = placed.select("id", "_block", "_at", sums(so_far).alias("_head"), sums(from_here).alias("_tail"))
    by_place = own.orderBy("_at")
    none = F.lit(None).cast(running.schema["_head"].dataType)
    # A change of the tail is known also where there is none any more; hence a struct in a struct.
    change = lambda at, tail, head: F.struct(at.alias("at"), tail.alias("tail"), head.alias("head"))
    known, unknown = lambda sums: F.struct(sums.alias("of")), F.lit(None).cast(
        T.StructType([T.StructField("of", running.schema["_head"].dataType)])
    )
    tails = running.withColumns({
        "_next": F.lead("_tail").over(by_place), "_first": F.lag("_at").over(by_place).isNull(),
    }).select("id", "_block", F.explode(F.filter(F.array(
        F.when(F.col("_first"), change(F.lit(0).cast("long"), known(F.col("_tail")), none)),
        change(F.col("_at") + 1, known(F.col("_next")), none),
    ), lambda c: c.isNotNull())).alias("_c"))
    heads = running.select(
        "id", (F.col("_block") - 1).alias("_block"), change(F.col("_at") + 1, unknown, F.col("_head")).alias("_c")
    )
    by_change = own.orderBy("_c.at")
    until_now = by_change.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = tails.unionByName(heads).where(F.col("_c.at") < per_block).select(
        "id", "_block", F.col("_c.at").alias("_from"),
        F.lead("_c.at", 1, per_block).over(by_change).alias("_to"),
        F.last("_c.tail", ignorenulls=True).over(until_now)["of"].alias("_tail"),
        F.last("_c.head", ignorenulls=True).over(until_now).alias("_head"),
    ).where((F.col("_from") < F.col("_to")) & (F.col("_tail").isNotNull() | F.col("_head").isNotNull()))
    added = F.col("_tail.value") + F.col("_head.value")
    return spans.select(
        "id", F.greatest("_tail.ts", "_head.ts").alias("ts"),
        F.coalesce(added, "_tail.value", "_head.value").alias("value"),
        F.explode(F.sequence(F.col("_from"), F.col("_to") - 1)).alias("_place"), "_block",
    ).select(((F.col("_block") * per_block + F.col("_place")) * slide).alias("window_start"), "ts", "id", "value")


def session_aggregate(
    df: DataFrame,
    key: str,
    time: str,
    order: Sequence[str],
    gap_ticks: int,
    aggregates: dict[str, tuple[str, Column]],
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per session: ``key, session_start, session_end`` and the aggregates.

    A session is a run of a key's rows no more than ``gap_ticks`` apart
    (inclusive); it ends ``gap_ticks`` after its last row. ``aggregates`` maps a
    name to (``min`` | ``max`` | ``sum``, column).

    Rows of a table that lie in one stretch of time as long as the gap are in one session. Where keys
    have some rows these are summed up, for most of them before a shuffle, and sessions are
    made of what is left; a table of ever new keys takes one shuffle instead.

    Chunks of a cut key are sessionised apart. Only the first and the last
    session of a chunk can go on in a neighbour; these, at most two per chunk,
    are merged in a second step. All other sessions are final.
    """
    session_time = F.col("event_time") if df.isStreaming else F.timestamp_millis(F.col(time))
    length = f"{gap_ticks} milliseconds"
    sizes = None if df.isStreaming or max_group_rows is None else key_sizes(df, key)
    if sizes and sizes.mean >= ROWS_TO_SUM:
        df = _stretches(df, key, time, gap_ticks, aggregates)
        aggregates = {name: (how, F.col(name)) for name, (how, _) in aggregates.items()}
        order, session_time = ("_from",), F.timestamp_millis("_from")
        length = F.concat((F.col("_to") - F.col("_from") + gap_ticks).cast("string"), F.lit(" milliseconds"))
    session = F.session_window(session_time, length)
    split = split_hot_groups(df, key, order, None if df.isStreaming else max_group_rows, sizes)
    local = (
        split.rows.groupBy(*split.keys, session.alias("_s"))
        .agg(*[_MERGE[how](column).alias(name) for name, (how, column) in aggregates.items()])
        .select(
            *split.keys,
            F.unix_millis("_s.start").alias("session_start"),
            F.unix_millis("_s.end").alias("session_end"),
            *aggregates,
        )
    )
    if not split.is_split:
        return local

    chunk = Window.partitionBy(*split.keys)
    start = F.col("session_start")
    outer = (start == F.min(start).over(chunk)) | (start == F.max(start).over(chunk))
    marked = local.withColumn("_outer", outer)
    final = marked.where(~(split.is_hot & F.col("_outer"))).drop(CHUNK, "_outer")

    ordered = Window.partitionBy(key).orderBy("session_start", CHUNK)
    reach = F.max("session_end").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(start <= F.col("_reach"), 0).otherwise(1)
    merged = (
        marked.where(split.is_hot & F.col("_outer"))
        .withColumn("_reach", reach)
        .withColumn("_n", F.sum(new).over(ordered))
        .groupBy(key, "_n")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            *[_MERGE[how](name).alias(name) for name, (how, _) in aggregates.items()],
        )
        .drop("_n")
    )
    return final.unionByName(merged)


def _stretches(
    df: DataFrame, key: str, time: str, gap_ticks: int, aggregates: dict[str, tuple[str, Column]]
) -> DataFrame:
    """``key, _from, _to`` and the aggregates per key and stretch of ``gap_ticks`` that has rows."""
    ticks = F.col(time).cast("long")
    return (
        df.where(F.col(time).isNotNull())
        .groupBy(key, F.floor(ticks / max(gap_ticks, 1)).alias("_stretch"))
        .agg(
            F.min(ticks).alias("_from"),
            F.max(ticks).alias("_to"),
            *[_MERGE[how](column).alias(name) for name, (how, column) in aggregates.items()],
        )
        .drop("_stretch")
    )


def with_previous(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    previous: dict[str, tuple[str, int]],
    max_group_rows: int | None = MAX_GROUP_ROWS,
    where: Column | None = None,
) -> DataFrame:
    """Rows with values of earlier rows of their key: the count window of n rows
    that slides by one, seen from its last row.

    ``previous`` maps a name to (column, how many rows back); null where the key
    has fewer rows. ``where`` tells which of the rows are wanted.

    Rows of hot keys are walked in ranges of their order after the one shuffle that
    deals them out; only wanted rows are written, and those at the edges of a range, at
    most twice the depth. A range's first rows are looked up once more among the edges.
    """
    chosen = F.lit(True) if where is None else where
    frame = Window.partitionBy(key).orderBy(*order)
    lags = [F.lag(column, n).over(frame).alias(name) for name, (column, n) in previous.items()]
    apart = hot_apart(df, key, order, max_group_rows)
    if apart is None:
        return df.select("*", *lags).where(chosen)
    cold, hot = apart
    plain = df.schema.fields
    found = [T.StructField(name, df.schema[column].dataType) for name, (column, _) in previous.items()]
    own = [T.StructField(_AT, T.LongType()), T.StructField(_EDGE, T.ByteType())]
    walked = hot.withColumn(_AT, F.monotonically_increasing_id()).mapInArrow(
        _previous_in_range(key, previous), T.StructType([*plain, *found, *own])
    )
    ranges = staged(walked.where(chosen | (F.col(_EDGE) != _INNER)), "previous")
    inner = ranges.where(F.col(_EDGE) == _INNER).drop(_AT, _EDGE)
    by_place = Window.partitionBy(key).orderBy(_AT)
    names = [f.name for f in plain]
    edges = ranges.where(F.col(_EDGE) != _INNER).select(
        *names, *[F.lag(column, n).over(by_place).alias(name) for name, (column, n) in previous.items()], _EDGE
    )
    first = edges.where(F.col(_EDGE) == _FIRST).drop(_EDGE).where(chosen)
    return cold.select("*", *lags).where(chosen).unionByName(inner).unionByName(first)


_AT, _EDGE = "_at", "_edge"
# A row whose earlier rows are all in its range; one of the first of a range; a copy of one of the last.
_INNER, _FIRST, _LAST = 0, 1, 2


def _runs(values: pa.Array) -> np.ndarray:
    """Numbers of the runs of equal values; nulls are equal, and so are NaNs."""
    a, b = values.slice(1), values.slice(0, max(len(values) - 1, 0))
    same = pc.fill_null(pc.equal(a, b), False)
    same = pc.or_(same, pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(values.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return np.concatenate([[0], np.cumsum(~same.to_numpy(zero_copy_only=False))])


def _previous_in_range(key: str, previous: dict[str, tuple[str, int]]) -> Callable:
    """Rows of one range, in order, with the values of earlier rows of their key in that range."""
    depth = max(n for _, n in previous.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0

        def framed(rows: pa.Table, low: int, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
            """From row ``low`` on."""
            at, run_of = np.arange(low, rows.num_rows), _runs(rows[key].combine_chunks())
            columns = [c.slice(low) for c in rows.columns[:-1]]
            for column, n in previous.values():
                known = at >= n
                known[known] = run_of[at[known]] == run_of[at[known] - n]
                columns.append(rows[column].take(pa.array(at - n, mask=~known)))
            names = [*rows.column_names[:-1], *previous, _AT, _EDGE]
            yield from pa.table([*columns, rows[_AT].slice(low), pa.array(edge, pa.int8())], names).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            low = 0 if last is None else last.num_rows
            rows = rows if last is None else pa.concat_tables([last, rows]).combine_chunks()
            place = seen + np.arange(batch.num_rows)
            yield from framed(rows, low, np.where(place < depth, _FIRST, _INNER).astype(np.int8))
            seen += batch.num_rows
            last = rows.slice(max(rows.num_rows - depth, 0))
        if last is not None:
            again = last.slice(max(0, last.num_rows - max(seen - depth, 0)))
            if again.num_rows:
                yield from framed(again, 0, np.full(again.num_rows, _LAST, np.int8))

    return run
