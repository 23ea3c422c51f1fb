import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadpulse.functions.text import numbered_tokens, running_word_count, tokens, word_count
from roadpulse.operators import windows
from roadpulse.operators.filters import above, fan_out
from roadpulse.operators.rolling import rolling
from roadpulse.operators.windows import sliding_sum
from roadpulse.plans.jobs import SAMPLE_LINES
from roadpulse.sources.readers import from_elements

READINGS = [(1, "a", 5.0), (2, "b", 1.0), (2, "a", 3.0), (3, "a", 7.0)]


def test_threshold_is_strict(make_sensor):
    kept = above(make_sensor([(1, "a", 20.0), (2, "a", 20.1)]))
    assert [r[:3] for r in rows(kept)] == [(2, "a", 20.1)]


def test_fan_out(make_sensor):
    out = fan_out(make_sensor([(1, "sensor1", 5.0), (2, "sensor2", 6.0)]))
    assert rows(out.select("ts", "id", "value")) == [
        (1, "sensor1", 1.0), (1, "sensor1", 5.0), (1, "this is a string test", 134.0),
    ]


@pytest.mark.parametrize(
    "kind, expected",
    [
        ("min", [(1, "a", 3.0), (1, "a", 3.0), (1, "a", 5.0), (2, "b", 1.0)]),
        ("max", [(1, "a", 5.0), (1, "a", 5.0), (1, "a", 7.0), (2, "b", 1.0)]),
        ("sum", [(1, "a", 5.0), (1, "a", 8.0), (1, "a", 15.0), (2, "b", 1.0)]),
        ("reduce", [(1, "a", 5.0), (2, "a", 8.0), (2, "b", 1.0), (3, "a", 15.0)]),
    ],
)
def test_rolling_yields_a_row_per_row(make_sensor, kind, expected):
    assert rows(rolling(make_sensor(READINGS), kind).select("ts", "id", "value")) == expected


def test_rolling_in_arrival_order(make_sensor):
    late = make_sensor([(9, "a", 1.0), (2, "a", 2.0)])
    assert rows(rolling(late, "min", order=("seq",)).select("ts", "value")) == [(9, 1.0), (9, 1.0)]
    assert rows(rolling(late, "reduce", order=("seq",)).select("ts", "value")) == [(2, 3.0), (9, 1.0)]


def test_unknown_kind(make_sensor):
    with pytest.raises(ValueError):
        rolling(make_sensor(READINGS), "median")


def brute_force_sliding(readings, size, slide):
    out = {}
    for ts, id_, value in readings:
        for start in range(ts - ts % slide - size, ts + 1):
            if start % slide == 0 and start <= ts < start + size:
                old = out.get((start, id_), (ts, 0.0))
                out[start, id_] = (max(old[0], ts), old[1] + value)
    return sorted((start, ts, id_, value) for (start, id_), (ts, value) in out.items())


@pytest.mark.parametrize("size, slide", [(3, 1), (5, 1), (6, 3), (4, 4)])
def test_sliding_sum(make_sensor, size, slide):
    readings = READINGS + [(10, "b", 2.0), (11, "b", 4.0), (-1, "b", 8.0), (11, "b", 16.0)]
    expected = brute_force_sliding(readings, size, slide)
    for panes in (False, True, None):
        assert rows(sliding_sum(make_sensor(readings), size, slide, panes)) == expected


def test_sliding_sum_with_uneven_slide(make_sensor):
    readings = make_sensor(READINGS)
    assert rows(sliding_sum(readings, 3, 2)) == brute_force_sliding(READINGS, 3, 2)
    with pytest.raises(ValueError):
        sliding_sum(readings, 3, 2, panes=True)


def test_tokens(spark):
    lines = from_elements(spark, ["To be, or not to be,--that"])
    assert rows(word_count(lines)) == [("be", 2), ("not", 1), ("or", 1), ("that", 1), ("to", 2)]
    assert rows(tokens(from_elements(spark, ["", "--", "É9_x"]))) == [("9_x",)]


def test_word_count_of_the_sample(spark):
    counts = dict(rows(word_count(from_elements(spark, SAMPLE_LINES))))
    assert counts["to"] == 4 and counts["the"] == 3 and counts["tis"] == 1
    assert sum(counts.values()) == 34


def test_running_word_count(spark):
    lines = from_elements(spark, ["b a b", "a, b"])
    assert rows(running_word_count(lines)) == [
        (0, 0, "b", 1), (0, 1, "a", 1), (0, 2, "b", 2), (1, 0, "a", 2), (1, 1, "b", 3),
    ]
    assert numbered_tokens(lines).columns == ["seq", "pos", "word"]


def test_filters_and_columns_reach_the_files(spark, tmp_path, make_reports):
    from roadpulse.plans.detectors import speed_fines

    make_reports([(1, 1, 95, 0, 0, 1, 1)]).write.parquet(str(tmp_path / "r"))
    plan = speed_fines(spark.read.parquet(str(tmp_path / "r")))._jdf.queryExecution().toString()
    assert "GreaterThan(spd,90)" in plan
    scanned = plan[plan.rindex("ReadSchema"):]
    assert "pos" not in scanned and "lane" not in scanned


def test_one_shuffle_per_keyed_operator(make_sensor, make_reports):
    from roadpulse.plans.detectors import accidents, average_speed_fines

    reports, sensor = make_reports([(1, 1, 95, 0, 0, 1, 1)]), make_sensor(READINGS)
    for df in (
        accidents(reports), average_speed_fines(reports), rolling(sensor, "sum"),
        sliding_sum(sensor, panes=False), word_count(sensor.select(F.col("id").alias("value"))),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Exchange") == 1
    # By panes: rows are summed per slide, then the sums per window.
    plan = sliding_sum(sensor)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


@pytest.mark.parametrize("size, slide", [(3, 1), (20, 1), (60, 3), (100, 5)])
def test_windows_from_blocks_equal_spread_panes(spark, size, slide):
    rng = random.Random(size)
    data = [(rng.randrange(-300, 900), rng.choice(["a", "b", None]), float(rng.randrange(100))) for _ in range(150)]
    data += [(5, "c", 1.0), (5, "c", None), (6, "d", None)]
    panes = windows._panes(spark.createDataFrame(data, "ts long, id string, value double"), slide)
    spread = windows._windows_by_spreading(panes, size, slide)
    together = windows._windows_from_blocks(panes, size, slide)
    assert together.columns == spread.columns and together.dtypes == spread.dtypes
    assert sorted(map(str, together.collect())) == sorted(map(str, spread.collect()))
