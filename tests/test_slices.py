"""Whole streams are fed in slices of time, of which the disk holds one at a time."""

import glob
import re
from datetime import datetime, timedelta

import __spark_entry__ as entry_point
import pytest
from conftest import rows

from roadpulse import views
from roadpulse.streaming.bounded import BoundedInput

QUERIES = entry_point.queries()
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


@pytest.fixture
def tables(spark, tmp_path):
    """Trips that overlap, and lines of several lengths."""
    start = datetime(2024, 1, 1)
    events = [
        (i, start + timedelta(seconds=97 * i), i % 6, "error" if i % 3 == 0 else "click", 50.0 + i)
        for i in range(90)
    ]
    spark.createDataFrame(events, EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    lines = [(i, " ".join(f"w{j % 7}" for j in range(i % 20))) for i in range(120)] + [(120, None)]
    spark.createDataFrame(lines, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("stream, table, whole, slice_rows", [
    ("stream_running_word_count", "running_word_count", 121, 200),
    ("stream_telematics_job", "telematics_findings", None, 1300),
    ("stream_accidents", "accidents_telematics", None, 1300),
])
def test_a_stream_holds_one_slice_and_little_state(
    spark, tables, monkeypatch, stream, table, whole, slice_rows
):
    held, append = [], BoundedInput.append

    def watched(self, slice_):
        append(self, slice_)
        held.append(spark.read.parquet(self.input).count())

    monkeypatch.setattr(BoundedInput, "append", watched)
    monkeypatch.setattr(entry_point, "SLICE_ROWS", slice_rows, raising=False)
    monkeypatch.setattr(entry_point, "scratch_dir", lambda _, label: f"{tables}/scratch")
    got = rows(QUERIES[stream](spark, tables).na.fill(-1))
    whole = whole or views.reports(spark, tables).count()
    assert sum(held) == whole and len(held) == 3 and max(held) < whole / 2
    assert spark.read.parquet(f"{tables}/scratch/input").count() == 0
    versions = [f for f in glob.glob(f"{tables}/scratch/checkpoint/state/0/0/*") if re.search(r"/\d+\.zip$", f)]
    assert len(versions) == 2
    expected = rows(QUERIES[table](spark, tables).na.fill(-1))
    assert got == expected and got


@pytest.mark.parametrize("slice_rows", [300, 1500, 10**9])
def test_slices_of_reports_are_all_reports_in_order_of_time(spark, tables, monkeypatch, slice_rows):
    untimed = spark.createDataFrame([(90, None, 1, "click", 70.0)], EVENTS)
    untimed.write.mode("append").parquet(f"{tables}/events.parquet")
    monkeypatch.setattr(entry_point, "SLICE_ROWS", slice_rows)
    slices = [rows(s.na.fill(-1)) for s in entry_point._report_slices(spark, tables)]
    assert sorted(r for s in slices for r in s) == rows(views.reports(spark, tables).na.fill(-1))
    assert sum(r[1] == -1 for r in slices[0]) == views.REPORTS
    times = [[r[1] for r in s if r[1] != -1] for s in slices]
    assert all(max(a) < min(b) for a, b in zip(times, times[1:]))
    # A slice from 0 on makes reports of the trips that began before.
    late = views.reports(spark, tables, None, 0, 60)
    assert rows(late) == rows(views.reports(spark, tables).where("time >= 0 and time < 60"))


def test_slices_of_one_time_or_none(spark):
    same = spark.createDataFrame([(5, i) for i in range(8)], "ts long, seq long")
    assert sorted(r for s in entry_point._slices(same, "ts") for r in rows(s)) == rows(same)
    none = spark.createDataFrame([(None, 1)], "ts long, seq long")
    assert [rows(s) for s in entry_point._slices(none, "ts")] == [[(None, 1)]]
    empty = none.where("seq > 1")
    assert [rows(s) for s in entry_point._slices(empty, "ts")] == [[]]
