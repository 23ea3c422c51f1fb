"""Per-record stateful operators on streams, in the order of event time.

Spark's built-in stream aggregates yield one row per key and micro-batch; these processors yield
one row per input row, and count windows that reach over micro-batches. Rows are held in state
until the watermark has passed them and are then walked in order of event time and arrival number,
so input shuffled within the watermark's delay gives what sorted input gives. Rows behind the
watermark are late: dropped, and counted per key. A stream without event time is taken in
arrival order, micro-batch by micro-batch, instead.

Held rows lie in the state as sorted runs, each cut into pages. Runs are merged page by page,
so the memory of a task does not depend on how many rows of a key wait or come in one
micro-batch. Keys are dealt to ``buckets``; a bucket is one group of Spark's stateful operator and
its rows are walked together, many keys at once in numpy. Running values are kept in packed parts.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# The processors travel with the plan, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 256
PAGE_ROWS = 4096
RUN_ROWS = 16 * PAGE_ROWS
# As many runs of about one size are kept.
MOST_RUNS = 12
# Rows that are turned into results at once, parts of a bucket's running values, and keys of them
# in memory.
WALK_ROWS = 8 * PAGE_ROWS
PARTS = 128
HELD_KEYS = 200_000
# Rows that a task sorts by bucket before it sends them on, and how many it packs into one.
SENT_ROWS = 64 * PAGE_ROWS
PACKED_ROWS = 256
# Names that start with an underscore would reach the processor changed.
_MS = "event_ms"
_BUCKET = "key_bucket"
_ROWS = "packed_rows"
FOREVER = 2**63 - 1

Columns = dict[str, np.ndarray]


def _packed(rows: Columns) -> bytes:
    arrays = [pa.array(v, from_pandas=v.dtype == object) for v in rows.values()]
    return _message(pa.RecordBatch.from_arrays(arrays, names=list(rows)))


def _message(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> Columns:
    return _columns([pa.ipc.open_stream(data).read_next_batch()])


def _columns(batches: list[pa.RecordBatch]) -> Columns:
    rows = pa.Table.from_batches(batches)
    plain = lambda t: pa.types.is_integer(t) or pa.types.is_floating(t)
    return {
        name: c.to_numpy() if plain(c.type) else c.to_pandas().to_numpy()
        for name, c in zip(rows.schema.names, rows.columns)
    }


def _opened(frames: Iterator[pd.DataFrame]) -> Iterator[Columns]:
    """Rows as ``_by_bucket`` packed them, or plain ones, as columns."""
    for frame in frames:
        if _ROWS not in frame.columns:
            yield {c: frame[c].to_numpy() for c in frame.columns if c != _BUCKET}
            continue
        some, n = [], 0
        for data in frame[_ROWS]:
            batch = pa.ipc.open_stream(data).read_next_batch()
            some.append(batch)
            n += batch.num_rows
            if n >= PAGE_ROWS:
                yield _columns(some)
                some, n = [], 0
        if some:
            yield _columns(some)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows packed by bucket, a few hundred to a row: Spark hands plain rows to a stateful
    operator in Python one by one, which takes longer than the rest of the work."""
    some, n = [], 0
    for batch in batches:
        some.append(batch)
        n += batch.num_rows
        if n >= SENT_ROWS:
            yield from _dealt(some)
            some, n = [], 0
    if n:
        yield from _dealt(some)


def _dealt(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches)
    buckets = rows.column(_BUCKET).to_numpy()
    order = np.argsort(buckets, kind="stable")
    buckets = buckets[order]
    rows = rows.drop_columns([_BUCKET]).take(order).combine_chunks().to_batches()[0]
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    to, packed = [], []
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(buckets)]):
        for at in range(low, high, PACKED_ROWS):
            to.append(buckets[low])
            packed.append(_message(rows.slice(at, min(PACKED_ROWS, high - at))))
    for at in range(0, len(to), 256):
        arrays = [pa.array(to[at : at + 256], pa.int32()), pa.array(packed[at : at + 256], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=[_BUCKET, _ROWS])


def _size(rows: Columns) -> int:
    return len(next(iter(rows.values())))


def _part(rows: Columns, low: int, high: int | None = None) -> Columns:
    return {c: v[low:high] for c, v in rows.items()}


def _joined(parts: list[Columns]) -> Columns:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _in_order(rows: Columns, order: Sequence[str]) -> Columns:
    columns = [rows[c] for c in order]
    if any(c.dtype == object for c in columns):
        at = pd.DataFrame({c: rows[c] for c in order}).sort_values(list(order), kind="stable").index.to_numpy()
    else:
        at = np.lexsort(columns[::-1])
    return {c: v[at] for c, v in rows.items()}


def _upto(rows: Columns, order: Sequence[str], low: int, limit: Sequence) -> int:
    """Where the rows from ``low`` on, which are sorted, pass the limit of the first columns."""
    high = _size(rows)
    for c, x in zip(order, limit):
        same = rows[c][low:high]
        low, high = low + int(same.searchsorted(x, "left")), low + int(same.searchsorted(x, "right"))
    return high


class SortedRuns:
    """Rows in state, in sorted runs of pages. ``order`` starts with the time they wait for."""

    def __init__(self, handle: StatefulProcessorHandle, order: Sequence[str]):
        self.order = list(order)
        self.pages = handle.getMapState("pages", "run long, page long", "rows binary")
        # Per run: its number, its first and its last page, the time of its first row.
        self.about = handle.getValueState("runs", "runs array<long>")

    def _runs(self) -> list[list[int]]:
        now = self.about.get()
        flat = list(now[0]) if now else []
        return [flat[i : i + 4] for i in range(0, len(flat), 4)]

    def _keep(self, runs: list[list[int]]) -> None:
        if runs:
            self.about.update(([x for run in runs for x in run],))
        elif self.about.exists():
            self.about.clear()

    def _write(self, run: int, page: int, rows: Columns) -> int:
        """Appends sorted rows to a run; the number of the next page."""
        for low in range(0, _size(rows), PAGE_ROWS):
            self.pages.updateValue((run, page), (_packed(_part(rows, low, low + PAGE_ROWS)),))
            page += 1
        return page

    def add(self, some: Iterator[Columns]) -> int | None:
        """Holds more rows; the time of the first row that waits."""
        runs = self._runs()
        for rows in _gathered(some, RUN_ROWS):
            rows = _in_order(rows, self.order)
            run = max((r[0] for r in runs), default=-1) + 1
            end = self._write(run, 0, rows)
            runs.append([run, 0, end - 1, int(rows[self.order[0]][0])])
            while len(alike := [r for r in runs if _level(r) == _level(runs[-1])]) > MOST_RUNS:
                runs = [r for r in runs if r not in alike] + [self._merged(alike, run := run + 1)]
        self._keep(runs)
        return min((r[3] for r in runs), default=None)

    def _merged(self, runs: list[list[int]], run: int) -> list[int]:
        page, first = 0, min(r[3] for r in runs)
        for rows in _gathered(self._walk(runs, FOREVER), PAGE_ROWS):
            page = self._write(run, page, rows)
        return [run, 0, page - 1, first]

    def take(self, until: int) -> Iterator[Columns]:
        """The rows up to a time, in order, some at a time; they are held no longer."""
        runs = self._runs()
        yield from self._walk(runs, until)
        self._keep(runs)

    def first(self) -> int | None:
        return min((r[3] for r in self._runs()), default=None)

    def _walk(self, runs: list[list[int]], until: int) -> Iterator[Columns]:
        """Merges the runs; afterwards ``runs`` says what is left of them."""
        held: dict[int, tuple[Columns, int]] = {}  # a page and where its rows go on
        time = self.order[0]
        while True:
            for r in runs:
                if r[0] not in held and r[1] <= r[2] and r[3] <= until:
                    held[r[0]] = _unpacked(self.pages.getValue((r[0], r[1]))[0]), 0
            if not held:
                return
            # Rows after the last one in memory of a run that goes on may have to come first.
            ends = [tuple(held[r[0]][0][c][-1] for c in self.order) for r in runs if r[0] in held and r[1] < r[2]]
            limit, ready = min(ends, default=None), []
            for r in runs:
                if r[0] not in held:
                    continue
                page, low = held[r[0]]
                n = _upto(page, self.order, low, (until,))
                if limit is not None:
                    n = min(n, _upto(page, self.order, low, limit))
                if n > low:
                    ready.append(_part(page, low, n))
                if n == _size(page):
                    self.pages.removeKey((r[0], r[1]))
                    r[1] += 1
                    del held[r[0]]
                    # A next page begins no earlier; its rows tell.
                    continue
                held[r[0]] = page, n
                r[3] = int(page[time][n])
                if r[3] > until:
                    if n:  # what is left is shorter than the page in the state
                        self.pages.updateValue((r[0], r[1]), (_packed(_part(page, n)),))
                    del held[r[0]]
            runs[:] = [r for r in runs if r[1] <= r[2]]
            if ready:
                yield ready[0] if len(ready) == 1 else _in_order(_joined(ready), self.order)


def _level(run: list[int]) -> int:
    """Runs of one level are merged into one of the next, so a row is moved once per level."""
    pages, level = run[2] - run[1] + 1, 0
    while pages > max(1, RUN_ROWS // PAGE_ROWS) * (MOST_RUNS + 1) ** level:
        level += 1
    return level


def _gathered(some: Iterator[Columns], most: int) -> Iterator[Columns]:
    """Few rows together, many cut, so that all but the last have as many as asked for."""
    parts, n = [], 0
    for rows in some:
        low, size = 0, _size(rows)
        while n + size - low >= most:
            parts.append(_part(rows, low, low + most - n))
            yield _joined(parts)
            low, parts, n = low + most - n, [], 0
        if low < size:
            parts.append(_part(rows, low))
            n += size - low
    if parts:
        yield _joined(parts)


def _name(key) -> str:
    if key is None or key != key:
        return "null"
    # Whole numbers come as doubles where there are nulls among them.
    return f"={int(key) if isinstance(key, float) and key.is_integer() else key}"


class RunningValues:
    """A list of numbers per key, kept in ``PARTS`` packed parts.

    A part is read and written once per call for all its keys, not once per key: with many keys
    these exchanges with the state store are what takes time.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        self.state = handle.getMapState("state", "part int", "numbers string")
        self.held: dict[int, dict[str, list]] = {}
        self.touched: set[int] = set()

    def get(self, name: str) -> list | None:
        part = crc32(name.encode()) % PARTS
        if part not in self.held:
            now = self.state.getValue((part,))
            self.held[part] = json.loads(now[0]) if now else {}
        return self.held[part].get(name)

    def set(self, name: str, value: list) -> None:
        """After ``get`` of the same name."""
        part = crc32(name.encode()) % PARTS
        self.held[part][name] = value
        self.touched.add(part)

    def keep(self, at_most: int = 0) -> None:
        """Writes what changed and lets it go, if that is more than so many keys."""
        if sum(map(len, self.held.values())) <= at_most and at_most:
            return
        for part in self.touched:
            self.state.updateValue((part,), (json.dumps(self.held[part]),))
        self.held, self.touched = {}, set()


class _Ordered(StatefulProcessor):
    """Walks the rows of its keys in order; keeps a few numbers per key.

    A subclass turns (keys, how many rows each has, these rows one key after the other as columns,
    per key its numbers or None) into (result columns or None, new numbers per key).
    """

    def __init__(self, key: str, order: Sequence[str], results: Sequence[str], timed: bool = True):
        self.key, self.order, self.results, self.timed = key, list(order), list(results), timed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = SortedRuns(handle, ([_MS] if self.timed else []) + self.order)
        self.values = RunningValues(handle)
        # The order of the latest row that arrived, and per key, where there are any, how many rows
        # arrived in a micro-batch after it and how many of them too late to be used.
        self.latest = handle.getValueState("latest", "order string")
        self.arrivals = handle.getMapState("arrivals", "key string", "regressions long, late long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.timed:
            self.runs.add(self._watched(rows, None))
            yield from self._results(self.runs.take(FOREVER))
            return
        before = self.runs.first()
        now = self.runs.add(self._watched(rows, timerValues.getCurrentWatermarkInMs()))
        if now is not None and (before is None or now < before):
            self._wait(before, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._results(self.runs.take(timerValues.getCurrentWatermarkInMs()))
        now = self.runs.first()
        if now is not None:
            self.handle.registerTimer(now)

    def _wait(self, before: int | None, now: int) -> None:
        if before is not None:
            self.handle.deleteTimer(before)
        self.handle.registerTimer(now)

    def _watched(self, frames: Iterator[pd.DataFrame], watermark: int | None) -> Iterator[Columns]:
        """The rows that are in time; keeps count of those that come out of order."""
        old = self.latest.get()
        before = json.loads(old[0]) if old else None
        latest = before
        for rows in _opened(frames):
            if not _size(rows):
                continue
            late = np.zeros(_size(rows), bool)
            if watermark:  # 0: there is none yet
                late = rows[_MS] <= watermark
            columns = [rows[c] for c in self.order]
            if before is not None:
                behind = columns[0] < before[0]
                for i in np.flatnonzero(columns[0] == before[0]):
                    behind[i] = [c[i] for c in columns] < before
                self._count(rows[self.key], behind | late, late)
            top = columns[0].max()
            newest = max([c.item() if hasattr(c := col[i], "item") else c for col in columns]
                         for i in np.flatnonzero(columns[0] == top))
            latest = newest if latest is None else max(latest, newest)
            if late.any():
                rows = {c: v[~late] for c, v in rows.items()}
            if _size(rows):
                yield rows
        if latest != before:
            self.latest.update((json.dumps(latest),))

    def _count(self, keys: np.ndarray, behind: np.ndarray, late: np.ndarray) -> None:
        if not behind.any():
            return
        for key, at in _groups(keys[behind]):
            name = _name(key)
            n, dropped = self.arrivals.getValue((name,)) or (0, 0)
            self.arrivals.updateValue((name,), (n + len(at), dropped + int(late[behind][at].sum())))

    def _results(self, some: Iterator[Columns]) -> Iterator[pd.DataFrame]:
        for rows in _gathered(some, WALK_ROWS):
            codes, keys = pd.factorize(rows[self.key], use_na_sentinel=False)
            at, counts = np.argsort(codes, kind="stable"), np.bincount(codes, minlength=len(keys))
            names = [_name(key) for key in keys.tolist()]
            old = [self.values.get(name) for name in names]
            result, new = self.advance(keys, counts, {c: v[at] for c, v in rows.items()}, old)
            for name, value in zip(names, new):
                self.values.set(name, value)
            self.values.keep(HELD_KEYS)
            if result is not None:
                yield pd.DataFrame({c: result[c] for c in self.results})
        self.values.keep()

    def close(self) -> None:
        pass


def _groups(keys: np.ndarray) -> Iterator[tuple[object, np.ndarray]]:
    """Each key with the places of its rows, in order."""
    codes, names = pd.factorize(keys, use_na_sentinel=False)
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(names)))
    for key, low, high in zip(names, [0, *ends], ends):
        yield (None if key != key else key), order[low:high]


class RollingProcessor(_Ordered):
    """Running min, max, sum or reduce of ``value``; per key its first time and the value so far."""

    def __init__(self, kind: str, *args, **options):
        super().__init__(*args, **options)
        self.kind = kind

    def advance(self, keys, counts, rows, old):
        step = {"min": np.minimum, "max": np.maximum}.get(self.kind, np.add)
        running, new, end = [], [], 0
        for n, before in zip(counts.tolist(), old):
            values, end = rows["value"][end : end + n], end + n
            if before is not None:
                values = np.concatenate([[before[1]], values])
            running.append(step.accumulate(values)[-n:])
            first = int(rows["ts"][end - n]) if before is None else before[0]
            new.append([first, float(running[-1][-1])])
        if self.kind != "reduce":
            rows["ts"] = np.repeat(np.array([first for first, _ in new]), counts)
        return rows | {"value": np.concatenate(running)}, new


class CountProcessor(_Ordered):
    """Numbers the rows of a key; per key how many there were."""

    def advance(self, keys, counts, rows, old):
        before = np.array([0 if n is None else n[0] for n in old], dtype="int64")
        starts = np.cumsum(counts) - counts
        number = np.arange(1, counts.sum() + 1, dtype="int64") + np.repeat(before - starts, counts)
        return rows | {"count": number}, [[n] for n in (before + counts).tolist()]


class StuckVehicleProcessor(_Ordered):
    """Four reports in a row from one place, see ``plans.detectors.accidents``; per key the fields
    of its last three reports, one after the other."""

    FIELDS = ("time", "seq", "xway", "seg", "dir", "pos")

    def __init__(self, same_dir: bool, *args, **options):
        super().__init__(*args, **options)
        self.place = ["pos", "dir"] if same_dir else ["pos"]

    def advance(self, keys, counts, rows, old):
        fields = list(self.FIELDS)
        n_before = np.array([0 if tail is None else len(tail) // len(fields) for tail in old])
        sizes = n_before + counts
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # Each key's rows come after what is kept of it.
        run = np.empty((ends[-1], len(fields)), "int64")
        is_new = np.ones(len(run), bool)
        kept = n_before > 0
        is_new[np.repeat((starts - (np.cumsum(n_before) - n_before))[kept], n_before[kept])
               + np.arange(n_before.sum())] = False
        run[~is_new] = np.array([x for tail in old if tail for x in tail], "int64").reshape(-1, len(fields))
        run[is_new] = np.stack([rows[c].astype("int64") for c in fields], axis=1)
        new = [run[max(low, high - 3) : high].flatten().tolist() for low, high in zip(starts, ends)]
        of = np.repeat(np.arange(len(keys)), sizes)
        hit = of[3:] == of[:-3]
        for c in self.place:
            place = run[:, fields.index(c)]
            hit &= (place[3:] == place[2:-1]) & (place[2:-1] == place[1:-2]) & (place[1:-2] == place[:-3])
        if not hit.any():
            return None, new
        first, last = dict(zip(fields, run[:-3][hit].T)), dict(zip(fields, run[3:][hit].T))
        found = {"time1": first["time"], "time2": last["time"], "vid": np.asarray(keys)[of[3:][hit]]}
        return found | {c: first[c] for c in ("xway", "seg", "dir", "pos")}, new


def _process(df: DataFrame, processor: _Ordered, schema: T.StructType, buckets: int) -> DataFrame:
    columns = [c for c in df.columns if c != "event_time"]
    bucket = F.pmod(F.xxhash64(processor.key), F.lit(buckets)).cast("int").alias(_BUCKET)
    if processor.timed:
        # Only as a number: Spark would drop late rows before the processor can count them.
        columns.append(F.unix_millis("event_time").alias(_MS))
    rows = df.select(bucket, *columns).mapInArrow(_by_bucket, f"{_BUCKET} int, {_ROWS} binary")
    return rows.groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append",
        timeMode="EventTime" if processor.timed else "None",
    )


def _timed(df: DataFrame) -> bool:
    return "event_time" in df.columns


def stream_rolling(
    df: DataFrame, kind: str, order: Sequence[str] = ("ts", "seq"), buckets: int = BUCKETS
) -> DataFrame:
    """``operators.rolling.rolling`` on a stream of ``(ts, id, value, seq)``.

    Here and below: with an ``event_time`` that has a watermark (``bounded.with_event_time``) rows
    come out once the watermark has passed them; without, with their micro-batch. ``buckets``, for
    as long as a checkpoint lives, is how many groups the keys are dealt to.
    """
    schema = T.StructType([f for f in df.schema.fields if f.name != "event_time"])
    processor = RollingProcessor(kind, "id", order, schema.names, timed=_timed(df))
    return _process(df, processor, schema, buckets)


def stream_running_count(
    df: DataFrame, key: str, order: Sequence[str], buckets: int = BUCKETS
) -> DataFrame:
    """``operators.rolling.running_count`` on a stream."""
    fields = [f for f in df.schema.fields if f.name != "event_time"]
    schema = T.StructType([*fields, T.StructField("count", T.LongType())])
    return _process(df, CountProcessor(key, order, schema.names, timed=_timed(df)), schema, buckets)


def stream_accidents(df: DataFrame, same_dir: bool, buckets: int = BUCKETS) -> DataFrame:
    """Accidents on a stream of reports that already passed the preset's filter."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = ("time1", "time2", "vid", "xway", "seg", "dir", "pos")
    schema = T.StructType([T.StructField(c, types.get(c, T.IntegerType())) for c in columns])
    timed = _timed(df)
    rows = df.select("vid", *StuckVehicleProcessor.FIELDS, *(["event_time"] if timed else []))
    processor = StuckVehicleProcessor(same_dir, "vid", ("time", "seq"), columns, timed=timed)
    return _process(rows, processor, schema, buckets)


def arrivals(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Per key of a processor above that has any, as of a micro-batch (default: the last one): how
    many rows came after a micro-batch with a later row of their bucket of keys (``regressions``), and
    how many of them behind the watermark, so that they were dropped (``late``).

    Read from the state of the query's checkpoint, also while it runs; keys come as text.
    """
    reader = spark.read.format("statestore").option("stateVarName", "arrivals")
    if batch is not None:
        reader = reader.option("batchId", batch)
    name = F.col("user_map_key.key")
    key = F.when(name.startswith("="), F.expr("substring(user_map_key.key, 2)")).alias("key")
    return reader.load(checkpoint).select(key, "user_map_value.*")
