"""One micro case per rule of the detectors."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from roadpulse.operators import filters
from roadpulse.plans.detectors import (
    ACCIDENT_RULES,
    AVERAGE_SPEED_RULES,
    accidents,
    average_speed_fines,
    speed_fines,
)


def trip(*points, vid=1, xway=2):
    """Reports of one vehicle from (time, dir, seg, pos)."""
    return [(t, vid, 80, xway, d, s, p) for t, d, s, p in points]


def section(t1=0, t2=100, dp=2800, dir1=0, dir2=0, vid=1, pos=1000):
    return trip((t1, dir1, 52, pos), (t2, dir2, 56, pos + dp), vid=vid)


def test_speed_fines_are_strictly_above_the_limit(make_reports):
    reports = make_reports([(1, 7, 90, 3, 1, 5, 11), (2, 7, 91, 3, 1, 5, 12)])
    assert rows(speed_fines(reports, "radar")) == [(2, 7, 3, 5, 1, 91)]
    assert rows(speed_fines(reports, "opt")) == [(2, 7, 3, 5, 12, 91)]
    assert speed_fines(reports, "radar").columns == ["time", "vid", "xway", "seg", "dir", "spd"]
    assert speed_fines(reports, "compact").columns == ["time", "vid", "xway", "seg", "pos", "spd"]


@pytest.mark.parametrize("preset, gap", [("telematics", 30_000), ("section60", 60_000)])
def test_gap_is_inclusive(make_reports, preset, gap):
    # 30 m per time unit, so that even a long gap gives a fine.
    joined = make_reports(section(0, gap, dp=30 * gap))
    apart = make_reports(section(0, gap + 1, dp=30 * (gap + 1)))
    assert rows(average_speed_fines(joined, preset)) == [(0, gap, 1, 2, 0, 67)]
    assert rows(average_speed_fines(apart, preset)) == []


def test_gap_can_be_set(make_reports):
    reports = make_reports(section(0, 31, dp=31 * 30))
    assert rows(average_speed_fines(reports, gap_ticks=30)) == []
    assert len(rows(average_speed_fines(reports, gap_ticks=31))) == 1


def test_entry_is_nearest_exit_is_farthest_and_later_arrival_wins(make_reports):
    reports = make_reports(
        trip(
            (0, 0, 52, 900), (10, 0, 52, 800), (20, 0, 52, 800), (25, 0, 52, 850),
            (100, 0, 56, 9000), (110, 0, 56, 9500), (120, 0, 56, 9500), (130, 0, 56, 9400),
        )
    )
    assert rows(average_speed_fines(reports)) == [(20, 120, 1, 2, 0, 195)]


def test_tie_at_the_same_time_goes_to_the_later_arrival(make_reports):
    tied = [(5, 1, 80, 1, 0, 52, 800), (5, 1, 80, 3, 0, 52, 800), (105, 1, 80, 1, 0, 56, 9000)]
    assert rows(average_speed_fines(make_reports(tied))) == [(5, 105, 1, 3, 0, 183)]


def test_westbound_times_are_not_ordered(make_reports):
    reports = make_reports(trip((0, 1, 56, 5000), (100, 1, 52, 1000)))
    assert rows(average_speed_fines(reports)) == [(100, 0, 1, 2, 1, 89)]


def test_directions_must_agree(make_reports):
    reports = make_reports(section(dir1=0, dir2=1))
    for preset in AVERAGE_SPEED_RULES:
        assert rows(average_speed_fines(reports, preset)) == []


def test_expressway_is_the_entrys_and_sessions_ignore_it(make_reports):
    reports = make_reports([(0, 1, 80, 1, 0, 52, 1000), (100, 1, 80, 3, 0, 56, 5000)])
    assert rows(average_speed_fines(reports)) == [(0, 100, 1, 1, 0, 89)]


@pytest.mark.parametrize(
    "dp, expected",
    [
        (2799, {"telematics": None, "section60": None, "opt": 60, "compact": 62.61}),
        (2800, {"telematics": 63, "section60": 63, "opt": 63, "compact": 62.63}),
        (2683, {"telematics": None, "section60": None, "opt": None, "compact": 60.02}),
        (2682, {"telematics": None, "section60": None, "opt": None, "compact": None}),
    ],
)
def test_arithmetic_variants(make_reports, dp, expected):
    reports = make_reports(section(dp=dp))
    for preset, value in expected.items():
        got = [round(r[5], 2) for r in rows(average_speed_fines(reports, preset))]
        assert got == ([] if value is None else [value]), preset


def test_result_types(make_reports):
    compact = make_reports(section()).withColumns(
        {c: F.col(c).cast("byte") for c in ("xway", "dir", "seg")}
    )
    assert dict(average_speed_fines(make_reports(section())).dtypes)["avgspd"] == "int"
    assert dict(average_speed_fines(compact, "compact").dtypes) == {
        "time1": "int", "time2": "int", "vid": "int", "xway": "tinyint", "dir": "tinyint",
        "avgspd": "double",
    }


def test_no_time_passed_gives_no_row_and_no_error(make_reports):
    reports = make_reports(section(t1=50, t2=50))
    for preset in AVERAGE_SPEED_RULES:
        assert rows(average_speed_fines(reports, preset)) == []


def test_positions_of_zero_count_as_unset(make_reports):
    reports = make_reports(section(pos=0))
    assert rows(average_speed_fines(reports)) == []


def test_a_lone_end_gives_nothing(make_reports):
    reports = make_reports(trip((0, 0, 52, 1000)) + trip((0, 0, 56, 9000), vid=2))
    assert rows(average_speed_fines(reports)) == []


def test_section_filters(make_reports):
    reports = make_reports([(0, 1, 0, x, 0, s, 1) for s in range(51, 58) for x in (0, 1, 4)])
    kept = lambda df: rows(df.select("seg", "xway"))
    assert kept(filters.in_section(reports)) == [(s, x) for s in range(52, 57) for x in (0, 1, 4)]
    assert kept(filters.in_section_skipping_quiet_middle(reports)) == sorted(
        [(s, x) for s in (52, 56) for x in (0, 1, 4)] + [(s, 1) for s in (53, 54, 55)]
    )


def test_skipping_the_middle_may_split_a_session(make_reports):
    def points(xway):
        return trip(
            (0, 0, 52, 1000), (50_000, 0, 54, 2_000_000), (100_000, 0, 56, 3_001_000), xway=xway
        )

    assert len(rows(average_speed_fines(make_reports(points(1)), "compact"))) == 1
    assert rows(average_speed_fines(make_reports(points(4)), "compact")) == []


def stop(n, start=0, spd=0, pos=500, dir=0):
    return [(start + 30 * i, 9, spd, 1, dir, 10, pos) for i in range(n)]


@pytest.mark.parametrize("n, found", [(3, 0), (4, 1), (5, 2), (6, 3)])
def test_four_in_a_row_and_every_one_after(make_reports, n, found):
    for preset in ACCIDENT_RULES:
        got = rows(accidents(make_reports(stop(n)), preset))
        assert got == [(30 * i, 30 * i + 90, 9, 1, 10, 0, 500) for i in range(found)]


def test_prefilter_drops_a_moving_report_at_the_same_place(make_reports):
    reports = make_reports(stop(2) + stop(1, 60, spd=5) + stop(2, 90))
    assert len(rows(accidents(reports, "telematics"))) == 2
    assert rows(accidents(reports, "opt")) == [(0, 120, 9, 1, 10, 0, 500)]


def test_prefilter_closes_over_a_moving_report_elsewhere(make_reports):
    reports = make_reports(stop(2) + stop(1, 60, spd=5, pos=700) + stop(2, 90))
    assert rows(accidents(reports, "telematics")) == []
    assert len(rows(accidents(reports, "opt"))) == 1


def test_only_compact_wants_one_direction(make_reports):
    reports = make_reports(stop(2) + stop(1, 60, dir=1) + stop(1, 90))
    assert len(rows(accidents(reports, "opt"))) == 1
    assert rows(accidents(reports, "compact")) == []


def test_vehicles_do_not_mix(make_reports):
    mixed = [(30 * i, i % 2, 0, 1, 0, 10, 500) for i in range(6)]
    assert rows(accidents(make_reports(mixed))) == []


def test_expressway_and_segment_come_from_the_first_report(make_reports):
    reports = make_reports([(i, 9, 0, i, i % 2, 10 + i, 500) for i in range(4)])
    assert rows(accidents(reports)) == [(0, 3, 9, 0, 10, 0, 500)]


def test_row_order_of_the_input_does_not_matter(spark, sf):
    from roadpulse import views

    reports = views.reports(spark, sf)
    shuffled = reports.orderBy(F.rand(5))
    for detect in (average_speed_fines, accidents):
        assert rows(detect(reports, "opt")) == rows(detect(shuffled, "opt"))
