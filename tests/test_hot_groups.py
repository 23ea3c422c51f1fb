"""Keys too large for one task: the cut way gives what the plain way gives."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadpulse import views
from roadpulse.functions.text import running_word_count
from roadpulse.operators.hot_groups import CHUNK, split_hot_groups
from roadpulse.operators.rolling import rolling, rolling_together
from roadpulse.operators.windows import session_aggregate, with_previous
from roadpulse.plans.detectors import (
    ACCIDENT_RULES,
    AVERAGE_SPEED_RULES,
    accidents,
    average_speed_fines,
)


@pytest.fixture(scope="module")
def reports(spark, sf):
    """A third of all rows belongs to one vehicle."""
    all_ = views.reports(spark, sf)
    return all_.withColumn("vid", F.when(F.col("seq") % 300 < 100, 3).otherwise(F.col("vid"))).cache()


def test_chunks_follow_the_order_and_are_even(reports):
    split = split_hot_groups(reports, "vid", ("time", "seq"), 1500)
    assert split.is_split
    per_chunk = (
        split.hot.where("vid = 3").groupBy(CHUNK)
        .agg(F.count("*").alias("n"), F.min(F.struct("time", "seq")).alias("low"),
             F.max(F.struct("time", "seq")).alias("high"))
        .orderBy(CHUNK).collect()
    )
    assert len(per_chunk) >= 8
    assert max(r["n"] for r in per_chunk) < 3 * 1500
    for before, after in zip(per_chunk, per_chunk[1:]):
        assert before["high"] < after["low"]


def test_small_keys_stay_whole(reports):
    split = split_hot_groups(reports, "vid", ("time", "seq"), 5000)
    hot = {r[0] for r in split.hot.select("vid").distinct().collect()}
    assert hot == {3}
    assert not split_hot_groups(reports, "vid", ("time", "seq"), 10**6).is_split
    assert not split_hot_groups(reports, "vid", ("time", "seq"), None).is_split


def test_thousands_of_hot_keys_and_exact_chunks(spark):
    """No bound on hot keys or chunks: 3,000 keys of 20 rows, cut at 8."""
    rows_ = spark.range(60_000).selectExpr("id % 3000 as k", "id as at")
    split = split_hot_groups(rows_, "k", ("at",), 8)
    assert split.hot.select("k").distinct().count() == 3000
    sizes = split.rows.groupBy("k", CHUNK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 8
    assert split.rows.groupBy(CHUNK).count().agg(F.max("count")).first()[0] <= 8


@pytest.mark.parametrize("kind", ["min", "max", "sum", "reduce"])
def test_types_nulls_and_null_keys_do_not_depend_on_cutting(spark, kind):
    values = [(i, None if i % 3 == 0 else "a", None if i % 5 == 0 else i % 7, i) for i in range(60)]
    values += [(None, "a", 3, 100), (None, None, 4, 101)]
    df = spark.createDataFrame(values, "ts long, id string, value long, seq long")
    whole, cut = rolling(df, kind, max_group_rows=None), rolling(df, kind, max_group_rows=4)
    assert whole.dtypes == cut.dtypes
    key = lambda r: [(v is not None, v) for v in r]
    assert sorted(map(tuple, whole.collect()), key=key) == sorted(map(tuple, cut.collect()), key=key)


def test_one_time_for_a_whole_key(make_sensor):
    same = make_sensor([(7, "a", 1.0)] * 500)
    split = split_hot_groups(same, "id", ("ts", "seq"), 50)
    assert split.rows.select(CHUNK).distinct().count() >= 8
    got = rows(rolling(same, "sum", max_group_rows=50).select("seq", "value"))
    assert got == [(i, i + 1.0) for i in range(500)]


@pytest.mark.parametrize("kind", ["min", "max", "sum", "reduce"])
@pytest.mark.parametrize("size", [1, 7, 60])
def test_rolling(spark, sf, kind, size):
    sensor = views.sensor(spark, sf)
    tidy = lambda df: rows(df.withColumn("value", F.round("value", 6)))
    assert tidy(rolling(sensor, kind, max_group_rows=size)) == tidy(
        rolling(sensor, kind, max_group_rows=None)
    )


def test_running_word_count(spark, sf):
    lines = views.lines(spark, sf)
    assert rows(running_word_count(lines, max_group_rows=40)) == rows(
        running_word_count(lines, max_group_rows=None)
    )


@pytest.mark.parametrize("preset", ACCIDENT_RULES)
@pytest.mark.parametrize("size", [2, 400])
def test_accidents(reports, preset, size):
    whole = rows(accidents(reports, preset, None))
    assert whole and rows(accidents(reports, preset, size)) == whole


@pytest.mark.parametrize("preset", AVERAGE_SPEED_RULES)
@pytest.mark.parametrize("size", [3, 300])
def test_average_speed(reports, preset, size):
    whole = rows(average_speed_fines(reports, preset, max_group_rows=None))
    assert whole and rows(average_speed_fines(reports, preset, max_group_rows=size)) == whole


@pytest.mark.parametrize("gap", [0, 30, 3000])
@pytest.mark.parametrize("size", [2, 50])
def test_sessions_over_chunk_borders(reports, gap, size):
    aggregates = {"n": ("sum", F.lit(1)), "low": ("min", F.col("seq")), "top": ("max", F.col("pos"))}
    run = lambda m: rows(
        session_aggregate(reports, "vid", "time", ("time", "seq"), max(gap, 1), aggregates, m)
        .select("vid", "session_start", "session_end", *aggregates)
    )
    assert run(size) == run(None)


def test_lookback_over_chunks_smaller_than_the_frame(make_sensor):
    sensor = make_sensor([(i, "a", float(i)) for i in range(40)])
    previous = {"one": ("ts", 1), "three": ("ts", 3)}
    got = with_previous(sensor, "id", ("ts", "seq"), previous, max_group_rows=1)
    assert rows(got.select("ts", "one", "three").where("three is not null")) == [
        (i, i - 1, i - 3) for i in range(3, 40)
    ]
    assert got.count() == 40


def test_several_aggregates_of_one_shuffle(spark, sf):
    sensor = views.sensor(spark, sf)
    for size in (None, 60):
        together = rolling_together(sensor, ("min", "max", "sum"), max_group_rows=size)
        for kind in ("min", "max", "sum"):
            one = rolling(sensor, kind, max_group_rows=None).selectExpr("ts", "id", "seq", "round(value, 6)")
            assert rows(together.selectExpr("ts", "id", "seq", f"round({kind}, 6)")) == rows(one)
    plan = rolling_together(sensor, ("min", "max", "sum"), max_group_rows=None)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


@pytest.mark.parametrize("size", [5, 1_000_000])
@pytest.mark.parametrize("seed", range(3))
def test_sessions_of_sums_are_sessions_of_rows(spark, monkeypatch, seed, size):
    import random

    from roadpulse.operators import windows

    rng, gap = random.Random(seed), 10
    times = [(rng.choice([1, 2, None]), rng.choice([None, rng.randrange(-300, 300), gap * rng.randrange(-30, 30)]), i)
             for i in range(150)]
    df = spark.createDataFrame(times, "k int, t int, seq long").cache()
    expected = []
    for key in (1, 2, None):
        runs = []
        for t, seq in sorted((t, seq) for k, t, seq in times if k == key and t is not None):
            if not runs or t - runs[-1][-1][0] > gap:
                runs.append([])
            runs[-1].append((t, seq))
        expected += [(key, r[0][0], r[-1][0] + gap, min(q for _, q in r), sum(q for _, q in r)) for r in runs]
    for least in (1, 1000):
        monkeypatch.setattr(windows, "ROWS_TO_SUM", least)
        got = windows.session_aggregate(
            df, "k", "t", ("t", "seq"), gap, {"low": ("min", F.col("seq")), "all": ("sum", F.col("seq"))}, size
        )
        assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_sessions_shuffle_sums_whatever_the_settings(spark):
    from roadpulse.operators.windows import session_aggregate

    df = spark.range(0, 20_000, 1, 2).selectExpr("cast(id % 5 as int) k", "cast(id as int) t", "id seq")
    name = "spark.sql.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        out = session_aggregate(df, "k", "t", ("t", "seq"), 1000, {"low": ("min", F.struct("seq"))})
        assert out.count() == 5
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(name, before)
    # The first step sums per key and stretch before its shuffle; the raw rows are not shuffled.
    first = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "_groupingexpression" in first.split(")")[0] and "partial_min" in first


@pytest.mark.parametrize("most", [10, 1_000_000])
def test_keys_are_counted_once_and_not_kept(spark, most):
    from roadpulse.operators.hot_groups import key_sizes

    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(len(batch))
            yield batch

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.range(0, 100, 1, 2).selectExpr("id % 3 k", "id").mapInPandas(count, "k long, id long")
    sizes = key_sizes(df, "k")
    split = split_hot_groups(spark.range(100).selectExpr("id % 3 k", "id"), "k", ("id",), most, sizes)
    assert split.is_split == (most == 10) and (sizes.largest, round(sizes.mean, 2)) == (34, 33.33)
    assert counted.value == 100
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def _lookback(rows_, columns, depth):
    """(key, at, values of the rows before) by a plain loop."""
    out, before = [], {}
    for key, at in sorted(rows_, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen = before.setdefault(key, [])
        out.append((key, at, *(seen[-n] if len(seen) >= n else None for n in range(1, depth + 1))))
        seen.append(at)
    return out


@pytest.mark.parametrize("batch", [1, 2, 1000])
def test_previous_rows_over_ranges_batches_and_null_keys(spark, batch):
    import random

    some = random.Random(batch)
    places = some.sample(range(1000), 300)
    rows_ = [(some.choice([None, 1, 1, 1, 2, 3, 4, 5 + i]), at) for i, at in enumerate(places)]
    df = spark.createDataFrame(rows_, "k long, at long")
    previous = {f"p{n}": ("at", n) for n in (1, 2, 3)}
    names = {"spark.sql.shuffle.partitions": "60", "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch),
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {n: spark.conf.get(n) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        for most in (1, 2, 40):
            got = [tuple(r) for r in with_previous(df, "k", ("at",), previous, most).collect()]
            key = lambda r: (r[0] is not None, r[0] or 0, r[1])
            assert sorted(got, key=key) == _lookback(rows_, ("at",), 3)
        some_ = with_previous(df, "k", ("at",), previous, 1, F.col("at") - F.col("p3") < 20)
        expected = [r for r in _lookback(rows_, ("at",), 3) if r[4] is not None and r[1] - r[4] < 20]
        assert sorted((tuple(r) for r in some_.collect()), key=key) == expected and expected
    finally:
        for n, v in kept.items():
            spark.conf.set(n, v)


def test_accidents_of_hot_keys_shuffle_reports_once_and_write_few(reports, monkeypatch):
    """Only accidents and the edges of ranges are written between."""
    from roadpulse.operators import windows

    written = {}
    staged = windows.staged
    monkeypatch.setattr(windows, "staged", lambda df, label: written.setdefault(label, staged(df, label)))
    found = accidents(reports, "telematics", 500)
    assert found.count()
    assert list(written) == ["previous"]
    ranges = written["previous"]
    assert ranges.where("_edge = 0").count() <= found.count()
    assert ranges.where("_edge > 0").count() < reports.count() / 100
