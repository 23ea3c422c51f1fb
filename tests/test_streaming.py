"""What a stream gives out over several micro-batches is what the table gives."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadpulse import views
from roadpulse.functions.text import numbered_tokens, running_word_count, word_count
from roadpulse.operators.filters import above, fan_out
from roadpulse.operators.rolling import rolling
from roadpulse.operators.windows import sliding_sum
from roadpulse.plans.detectors import accidents, average_speed_fines, speed_fines
from roadpulse.schemas import REPORT, SENSOR, with_seq
from roadpulse.sources import readers, writers
from roadpulse.streaming.bounded import (
    ASCENDING,
    BoundedInput,
    replay,
    start_available,
    with_event_time,
)
from roadpulse.streaming.stateful import arrivals, stream_rolling, stream_running_count

END_OF_REPORTS = {"vid": -1, "time": 2**31 - 1, "seq": 0, "spd": 0, "xway": 0, "lane": 0,
                  "dir": 0, "seg": 52, "pos": 274560}


@pytest.fixture
def run(spark, tmp_path):
    """Feed slices through an operator; the slices arrive in separate runs."""

    def run(slices, operator, sentinel=None):
        root = str(tmp_path / "stream")
        source = BoundedInput(spark, root, slices[0].schema)
        schema = []

        def build(stream):
            result = operator(stream)
            schema.append(result.schema)
            return writers.stream_files(result, f"{root}/out", f"{root}/checkpoint")

        replay(source, slices, build, sentinel, 2)
        return spark.read.schema(schema[0]).parquet(f"{root}/out")

    return run


def cut(df, column, n=2):
    low, high = df.agg(F.min(column), F.max(column)).first()
    part = F.floor((F.col(column) - low) / ((high - low) // n + 1))
    return [df.where(part == i) for i in range(n)]


@pytest.fixture(scope="module")
def reports(spark, sf):
    return views.reports(spark, sf).where("vid < 8").cache()


@pytest.fixture(scope="module")
def sensor(spark, sf):
    return views.sensor(spark, sf).where("seq < 300").cache()


def test_row_wise_operators_take_streams(run, reports):
    got = run(cut(reports, "time"), lambda s: speed_fines(s, "opt"))
    assert rows(got) == rows(speed_fines(reports, "opt"))


def test_sensor_operators_take_streams(run, sensor):
    got = run(cut(sensor, "ts"), lambda s: fan_out(above(s), "click"))
    assert rows(got) == rows(fan_out(above(sensor), "click"))


def test_accidents(run, reports):
    expected = rows(accidents(reports, "compact"))
    operator = lambda s: accidents(with_event_time(s, "time", delay=ASCENDING), "compact")
    got = run(cut(reports, "time", 3), operator, END_OF_REPORTS)
    assert expected and rows(got) == expected


def test_accidents_in_arrival_order(run, reports):
    got = run(cut(reports, "time", 2), lambda s: accidents(s, "compact"))
    assert rows(got) == rows(accidents(reports, "compact"))


def test_average_speed_needs_the_end_for_its_last_sessions(run, reports):
    expected = rows(average_speed_fines(reports))
    operator = lambda s: average_speed_fines(with_event_time(s, "time"))
    got = rows(run(cut(reports, "time"), operator, END_OF_REPORTS))
    assert expected and got == expected


def test_append_mode_keeps_the_last_session_open(run, make_reports):
    reports = make_reports([(0, 1, 80, 2, 0, 52, 1000), (100, 1, 80, 2, 0, 56, 9000)])
    operator = lambda s: average_speed_fines(with_event_time(s, "time"))
    assert rows(run([reports], operator)) == []


def test_the_end_record_closes_it(run, make_reports):
    reports = make_reports([(0, 1, 80, 2, 0, 52, 1000), (100, 1, 80, 2, 0, 56, 9000)])
    operator = lambda s: average_speed_fines(with_event_time(s, "time"))
    assert rows(run([reports], operator, END_OF_REPORTS)) == [(0, 100, 1, 2, 0, 179)]


def test_late_reading_of_a_closed_window_is_dropped(run, make_sensor):
    slices = [
        make_sensor([(10, "a", 1.0), (20, "a", 2.0)]),
        make_sensor([(11, "a", 64.0), (21, "a", 4.0)]),
    ]
    operator = lambda s: sliding_sum(with_event_time(s, "ts", "s"), 4, 4)
    end = {"ts": 4102444800, "id": "end", "value": 0.0, "seq": 0}
    assert rows(run(slices, operator, end)) == [(8, 10, "a", 1.0), (20, 21, "a", 6.0)]


def test_sliding_sum(run, sensor):
    end = {"ts": 4102444800, "id": "end", "value": 0.0, "seq": 0}
    operator = lambda s: sliding_sum(with_event_time(s, "ts", "s"))
    got = run(cut(sensor, "ts"), operator, end)
    tidy = lambda df: rows(df.withColumn("value", F.round("value", 6)))
    assert tidy(got) == tidy(sliding_sum(sensor))


END_OF_READINGS = {"ts": 4102444800, "id": "end", "value": 0.0, "seq": 0}


def test_wide_sliding_sum_by_panes(run, sensor):
    operator = lambda s: sliding_sum(with_event_time(s, "ts", "s"), 3600, 600, panes=True)
    got = run(cut(sensor, "ts"), operator, END_OF_READINGS)
    tidy = lambda df: rows(df.withColumn("value", F.round("value", 6)))
    assert tidy(got) == tidy(sliding_sum(sensor, 3600, 600))


@pytest.mark.parametrize("kind", ["min", "reduce"])
def test_rolling(run, sensor, kind):
    got = run(
        cut(sensor, "ts"), lambda s: stream_rolling(with_event_time(s, "ts", "s", ASCENDING), kind), END_OF_READINGS
    )
    tidy = lambda df: rows(df.withColumn("value", F.round("value", 6)))
    assert tidy(got) == tidy(rolling(sensor, kind))


def test_a_count_per_token(run, spark):
    lines = readers.from_elements(spark, ["b a b", "a, b", "b c"])
    slices = [lines.where("seq < 1"), lines.where("seq >= 1")]
    got = run(
        slices, lambda s: stream_running_count(numbered_tokens(s), "word", ("seq", "pos"))
    )
    assert rows(got) == rows(running_word_count(lines))


def test_late_and_shuffled_rows_are_counted_per_key_and_batch(run, spark, make_sensor, tmp_path):
    slices = [
        make_sensor([(100, "a", 1.0), (103, "b", 1.0)]),
        make_sensor([(99, "a", 2.0), (120, "a", 4.0), (50, "b", 64.0)]),
    ]
    operator = lambda s: stream_rolling(with_event_time(s, "ts", "s", "10 seconds"), "sum")
    got = run(slices, operator, END_OF_READINGS)
    assert [r[:3] for r in rows(got)] == [(99, "a", 2.0), (99, "a", 3.0), (99, "a", 7.0), (103, "b", 1.0)]
    counts = lambda batch: {
        r.key: (r.regressions, r.late) for r in arrivals(spark, str(tmp_path / "stream" / "checkpoint"), batch).collect()
    }
    last = counts(None)
    assert last == {"a": (1, 0), "b": (1, 1)} and counts(0) == {}


def test_running_totals_per_word(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = readers.stream_lines(spark, path=str(tmp_path / "in"))
    seen = []
    keep = lambda df, batch: seen.append(rows(df))
    writer = word_count(lines).writeStream.outputMode("update").foreachBatch(keep)
    writer = writer.option("checkpointLocation", str(tmp_path / "checkpoint"))
    for i, text in enumerate(["b a b\n", "a, b\n"]):
        (tmp_path / "in" / f"{i}.txt").write_text(text)
        start_available(spark, writer, 2).awaitTermination()
    assert seen == [[("a", 1), ("b", 2)], [("a", 2), ("b", 3)]]


def test_csv_stream_is_strict(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good, bad = "1,7,95,3,0,1,52,500,0\n", "1,7,95,3,0,,52,500,0\n"
    stream = readers.stream_csv(spark, str(tmp_path / "in"), with_seq(REPORT), 1)

    def go():
        writer = writers.stream_files(
            speed_fines(stream), str(tmp_path / "out"), str(tmp_path / "checkpoint"), "tuple"
        )
        start_available(spark, writer).awaitTermination()

    (tmp_path / "in" / "0.csv").write_text(good)
    go()
    assert [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["(1,7,3,52,1,95)"]
    (tmp_path / "in" / "1.csv").write_text(bad)
    with pytest.raises(Exception):
        go()


def test_csv_stream_numbers_its_lines(run, spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = readers.stream_csv(spark, str(tmp_path / "in"), SENSOR, 1, numbered=True)
    writer = writers.stream_files(stream_rolling(stream, "reduce"), str(tmp_path / "out"), str(tmp_path / "c"))
    for name, text in (("b.csv", "5,s,1.0\n5,s,2.0\n"), ("a.csv", "5,s,4.0\n5,s,8.0\n")):
        (tmp_path / "in" / name).write_text(text)
        start_available(spark, writer, 2).awaitTermination()
    got = spark.read.schema("ts long, id string, value double, seq string").parquet(str(tmp_path / "out"))
    assert [r.value for r in got.orderBy("seq").collect()] == [1.0, 3.0, 7.0, 15.0]


def test_running_words_of_a_text_stream(spark, tmp_path):
    from roadpulse.plans.jobs import running_words

    (tmp_path / "in").mkdir()
    for i, text in enumerate(("fox dog fox", "dog fox")):
        (tmp_path / "in" / f"{i}.txt").write_text(text + "\n")
    lines = readers.stream_lines(spark, path=str(tmp_path / "in"), maxFilesPerTrigger="1")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    start_available(spark, writers.stream_files(running_words(lines), out, checkpoint), 2).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("dog", 1), ("dog", 2), ("fox", 1), ("fox", 2), ("fox", 3)]


def test_console_stream_prints_every_row(spark, tmp_path, capfd):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text(" ".join(f"word{i}" for i in range(50)) + "\n")
    lines = readers.stream_lines(spark, path=str(tmp_path / "in"))
    query = start_available(spark, writers.stream_console(word_count(lines), "update"), 2)
    query.awaitTermination()
    assert query.recentProgress[0]["numInputRows"] == 1
    assert capfd.readouterr().out.count("(word") == 50


def test_restart_leaves_the_sessions_settings_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    lines = readers.stream_lines(spark, path=str(tmp_path))
    start_available(spark, writers.stream_console(lines), 3).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


@pytest.mark.parametrize("stream, table", [
    ("stream_telematics_job", "telematics_findings"), ("stream_keyed_reduce_files", "keyed_reduce_files"),
])
def test_whole_streams_bring_their_state_store(spark, sf, stream, table):
    from __spark_entry__ import queries

    names = ("spark.sql.streaming.stateStore.providerClass",
             "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition")
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        plain = {name: spark.conf.get(name) for name in names}
        got = rows(queries()[stream](spark, sf).na.fill(-1))
        assert {name: spark.conf.get(name) for name in names} == plain
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    expected = queries()[table](spark, sf)
    assert got == rows(expected.na.fill(-1))


def test_socket_lines_have_the_same_shape(spark):
    # Nothing connects before the query starts.
    lines = readers.stream_lines(spark, "socket", host="localhost", port="9999")
    assert lines.isStreaming and lines.columns == ["value"]
    assert word_count(lines).columns == ["word", "count"]


