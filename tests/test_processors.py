"""The stream processors alone: however the input is cut, the result is the same."""

import itertools
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from roadpulse.streaming import stateful
from roadpulse.streaming.stateful import CountProcessor, RollingProcessor, StuckVehicleProcessor


class Value:
    def __init__(self):
        self.now = None

    def exists(self):
        return self.now is not None

    def get(self):
        return self.now

    def update(self, new):
        self.now = new

    def clear(self):
        self.now = None


class Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Value())

    def getMapState(self, name, key_schema, value_schema):
        return self.states.setdefault(name, Map())

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class Now:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def feed(processor, batches, columns, time=None, delay=0, frame_rows=1):
    """Batches as Spark hands them over: first the rows, then timers that the watermark passed."""
    handle = Handle()
    processor.init(handle)
    out, seen = [], 0

    def take(frames):
        for frame in frames or ():
            out.extend(tuple(r) for r in frame.itertuples(index=False))

    for batch in [*batches, [], None]:
        now = Now(10**15 if batch is None else max(seen - delay, 0))
        if batch:
            # A key's rows may come as several frames, in any order.
            random.Random(len(batch)).shuffle(batch)
            frame = pd.DataFrame(batch, columns=columns).assign(key_bucket=1)
            if time:
                frame["event_ms"] = frame[time].astype("int64")
                seen = max(seen, int(frame["event_ms"].max()))
            frames = (frame.iloc[i : i + frame_rows] for i in range(0, len(frame), frame_rows))
            take(processor.handleInputRows((1,), frames, now))
        for timer in sorted(t for t in handle.timers if t <= now.watermark):
            if timer in handle.timers:
                handle.timers.remove(timer)
                take(processor.handleExpiredTimer((1,), now, None))
    return out, handle.states


def cuts(items, seed, most=4):
    rng, items = random.Random(seed), list(items)
    while items:
        n = rng.randint(1, most)
        yield items[:n]
        items = items[n:]


READINGS = [(t, k, v, i) for i, (t, k, v) in enumerate(
    [(3, "a", 5.0), (3, "a", 2.0), (4, "b", 9.0), (7, "a", 2.0), (7, "b", -1.0), (8, "a", 4.0),
     (9, None, 12.0), (9, "a", 0.5), (11, "b", 3.0), (12, None, 1.0)]
)]
SENSOR = ["ts", "id", "value", "seq"]


def running(kind):
    step = {"min": min, "max": max}.get(kind, lambda a, b: a + b)
    out, state = [], {}
    for ts, key, value, seq in READINGS:
        first, before = state.get(key, (ts, None))
        now = value if before is None else step(before, value)
        state[key] = (first, now)
        out.append((ts if kind == "reduce" else first, key, now, seq))
    return sorted(out, key=str)


@pytest.mark.parametrize("timed", [False, True])
@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("kind", ["min", "max", "sum", "reduce"])
def test_rolling(kind, seed, timed):
    processor = RollingProcessor(kind, "id", ("ts", "seq"), SENSOR, timed=timed)
    out, _ = feed(processor, cuts(READINGS, seed), SENSOR, "ts" if timed else None, 1)
    assert sorted(out, key=str) == running(kind)


@pytest.mark.parametrize("seed", range(20))
def test_input_shuffled_within_the_delay_gives_what_sorted_input_gives(seed, monkeypatch):
    for name, value in {"PAGE_ROWS": 2, "RUN_ROWS": 4, "MOST_RUNS": 2}.items():
        monkeypatch.setattr(stateful, name, value)
    rng = random.Random(seed)
    shuffled = sorted(READINGS, key=lambda r: r[0] + rng.random() * 4)
    processor = RollingProcessor("sum", "id", ("ts", "seq"), SENSOR)
    out, states = feed(processor, cuts(shuffled, seed), SENSOR, "ts", 5)
    assert sorted(out, key=str) == running("sum")
    assert not states["pages"] and not states["runs"].exists()


def test_late_rows_are_dropped_and_counted_per_key():
    batches = [
        [(10, "a", 1.0, 0), (20, "a", 2.0, 1), (15, "b", 1.0, 2)],
        [(12, "a", 64.0, 3), (30, "a", 4.0, 4), (14, "b", 1.0, 5), (20, "b", 1.0, 6)],
        [(25, "a", 8.0, 7)],
    ]
    processor = RollingProcessor("sum", "id", ("ts", "seq"), SENSOR)
    out, states = feed(processor, batches, SENSOR, "ts", 1, frame_rows=10)
    assert sorted(out) == [(10, "a", 1.0, 0), (10, "a", 3.0, 1), (10, "a", 7.0, 4),
                           (15, "b", 1.0, 2), (15, "b", 2.0, 6)]
    # One bucket: the 20 of b comes with a micro-batch, not after one, that has the 30 of a.
    assert states["arrivals"] == {("=a",): (2, 2), ("=b",): (1, 1)}


@pytest.mark.parametrize("timed", [False, True])
@pytest.mark.parametrize("seed", range(5))
def test_count(seed, timed):
    words = [(i // 3, i % 3, "vw"[i % 2]) for i in range(10)]
    processor = CountProcessor("word", ("seq", "pos"), ("seq", "pos", "word", "count"), timed=timed)
    out, _ = feed(processor, cuts(words, seed), ["seq", "pos", "word"], "seq" if timed else None, 1)
    late_first = [w for w in words if not (timed and w[0] < 0)]
    assert sorted(out) == sorted((*w, i // 2 + 1) for i, w in enumerate(late_first))


@pytest.mark.parametrize("same_dir", [False, True])
@pytest.mark.parametrize("seed", range(20))
def test_stuck_vehicle(seed, same_dir):
    rng, pos = random.Random(seed), 0
    reports = []
    for i in range(40):
        pos += rng.random() < 0.2
        reports.append((i, i, i % 3, i % 7, int(rng.random() < 0.1), pos))
    expected = []
    for four in zip(reports, reports[1:], reports[2:], reports[3:]):
        place = {(r[5], r[4] if same_dir else 0) for r in four}
        if len(place) == 1:
            first, last = four[0], four[3]
            expected.append((first[0], last[0], 9, *first[2:]))
    columns = ["time1", "time2", "vid", "xway", "seg", "dir", "pos"]
    processor = StuckVehicleProcessor(same_dir, "vid", ("time", "seq"), columns, timed=False)
    rows = [(9, *r) for r in reports]
    out, _ = feed(processor, cuts(rows, seed), ["vid", *StuckVehicleProcessor.FIELDS])
    assert expected and out == expected


def test_sorted_runs_hold_any_number_of_rows_in_little_memory():
    """A million rows of one key in one micro-batch, 40 MB of numbers: a few pages at a time."""
    handle, n = Handle(), 1_000_000
    seq = np.random.default_rng(0).permutation(n)

    class OnDisk(Map):  # pages count as state, not as memory of the task
        def updateValue(self, key, value):
            path = files / f"{key[0]}-{key[1]}"
            path.write_bytes(value[0])
            self[key] = path

        def getValue(self, key):
            return (self[key].read_bytes(),)

    import pathlib
    import tempfile

    files = pathlib.Path(tempfile.mkdtemp())
    handle.states["pages"] = OnDisk()
    processor = RollingProcessor("sum", "id", ("ts", "seq"), SENSOR)
    processor.init(handle)

    def frames():
        for low in range(0, n, 10_000):
            part = seq[low : low + 10_000]
            yield pd.DataFrame({"ts": part // 100, "id": "a", "value": 1.0, "seq": part,
                                "event_ms": part // 100 + 1, "key_bucket": 1})

    tracemalloc.start()
    list(processor.handleInputRows((1,), frames(), Now(0)) or ())
    place = 0
    for frame in processor.handleExpiredTimer((1,), Now(10**9), None):
        assert (frame["seq"].to_numpy() == np.arange(place, place + len(frame))).all()
        assert frame["value"].iloc[-1] == place + len(frame)
        place += len(frame)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    for path in files.iterdir():
        path.unlink()
    assert place == n and peak < 40_000_000, peak


def test_groups_keep_the_order_of_rows():
    keys = np.array(["b", None, "a", "b", None], dtype=object)
    assert {k: at.tolist() for k, at in stateful._groups(keys)} == {"b": [0, 3], None: [1, 4], "a": [2]}
    assert list(itertools.chain(*(at for _, at in stateful._groups(np.array([2, 1, 2]))))) == [0, 2, 1]


class Counting(Map):
    calls = 0

    def getValue(self, key):
        self.calls += 1
        return super().getValue(key)

    def updateValue(self, key, value):
        self.calls += 1
        super().updateValue(key, value)


def test_running_values_of_many_keys_take_few_exchanges_with_the_state():
    handle, n = Handle(), 60_000
    handle.states["state"] = Counting()
    processor = CountProcessor("word", ("seq", "pos"), ("seq", "pos", "word", "count"), timed=False)
    processor.init(handle)
    for batch in (0, 1):
        frame = pd.DataFrame({"seq": np.arange(n) + n * batch, "pos": 0, "word": [f"w{i % 7000}" for i in range(n)],
                              "key_bucket": 1})
        out = pd.concat(processor.handleInputRows((1,), iter([frame]), Now(0)))
    seen, most = np.bincount(np.arange(n) % 7000), out.groupby("word")["count"].max()
    assert all(most[f"w{i}"] == 2 * count for i, count in enumerate(seen))
    assert handle.states["state"].calls <= 4 * stateful.PARTS


def test_merging_of_runs_writes_a_row_a_few_times(monkeypatch):
    for name, value in {"PAGE_ROWS": 2, "RUN_ROWS": 2, "MOST_RUNS": 4}.items():
        monkeypatch.setattr(stateful, name, value)
    handle, n = Handle(), 2000
    handle.states["pages"] = Counting()
    runs = stateful.SortedRuns(handle, ["t"])
    order = np.random.default_rng(0).permutation(n)
    runs.add({"t": order[low : low + 2]} for low in range(0, n, 2))
    # Merged into one each time, a row would be moved some 160 times.
    assert handle.states["pages"].calls < 40 * n
    assert np.concatenate([rows["t"] for rows in runs.take(10**9)]).tolist() == list(range(n))


def test_rows_packed_by_bucket_are_all_there(monkeypatch):
    import pyarrow as pa

    for name, value in {"SENT_ROWS": 50, "PACKED_ROWS": 3}.items():
        monkeypatch.setattr(stateful, name, value)
    rng, n = random.Random(0), 230
    rows = [(rng.randrange(6), i, rng.choice(["a", None, "b"])) for i in range(n)]
    table = pa.table({"key_bucket": pa.array([r[0] for r in rows], pa.int32()), "seq": [r[1] for r in rows],
                      "id": [r[2] for r in rows]})
    got = []
    for batch in stateful._by_bucket(table.to_batches(max_chunksize=20)):
        for bucket, packed in zip(*(c.to_pylist() for c in batch.columns)):
            (part,) = stateful._opened([pd.DataFrame({"key_bucket": [bucket], "packed_rows": [packed]})])
            assert len(part["seq"]) <= 3
            got += [(bucket, s, i) for s, i in zip(part["seq"].tolist(), part["id"].tolist())]
    assert sorted(got, key=str) == sorted(rows, key=str)
