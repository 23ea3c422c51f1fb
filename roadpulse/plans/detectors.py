"""Speed fines, average-speed fines and accidents, each in its presets.

The detectors take position reports ``(time, vid, spd, xway, dir, seg, pos, seq)``
as a table or as a stream; ``seq`` is the arrival number that breaks ties of
``time``. Presets differ in their results, see the README.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.arithmetic import exact_mph, round_half_up, whole_mph
from roadpulse.operators import filters
from roadpulse.operators.hot_groups import MAX_GROUP_ROWS
from roadpulse.operators.windows import session_aggregate, with_previous

ARRIVAL = ("time", "seq")

SPEED_FINE_COLUMNS = {
    "radar": ("time", "vid", "xway", "seg", "dir", "spd"),
    "opt": ("time", "vid", "xway", "seg", "pos", "spd"),
    "compact": ("time", "vid", "xway", "seg", "pos", "spd"),
}


@dataclass(frozen=True)
class SectionRule:
    section: Callable[[DataFrame], DataFrame]
    gap_ticks: int
    exact: bool = False  # double arithmetic instead of whole metres per time unit
    compare_rounded: bool = True


AVERAGE_SPEED_RULES = {
    "section60": SectionRule(filters.in_section, 60_000),
    "telematics": SectionRule(filters.in_section, 30_000),
    "opt": SectionRule(filters.in_section, 30_000, compare_rounded=False),
    "compact": SectionRule(
        filters.in_section_skipping_quiet_middle, 60_000, exact=True, compare_rounded=False
    ),
}


@dataclass(frozen=True)
class AccidentRule:
    stopped_only: bool
    same_dir: bool


ACCIDENT_RULES = {
    "telematics": AccidentRule(stopped_only=False, same_dir=False),
    "opt": AccidentRule(stopped_only=True, same_dir=False),
    "compact": AccidentRule(stopped_only=True, same_dir=True),
}


def speed_fines(reports: DataFrame, preset: str = "radar", limit: int = 90) -> DataFrame:
    """Reports above the speed limit. Row-wise, batch and stream."""
    return filters.speeding(reports, limit).select(*SPEED_FINE_COLUMNS[preset])


def average_speed_fines(
    reports: DataFrame,
    preset: str = "telematics",
    limit: int = 60,
    gap_ticks: int | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Vehicles whose average speed over the section exceeds the limit.

    ``(time1, time2, vid, xway, dir, avgspd)``. Per vehicle and session, the
    entry is the report at the first segment with the smallest position, the exit
    the one at the last segment with the largest; the later arrival wins a tie.
    Both must have the same direction; expressway and direction are the entry's.
    A stream needs an event time, see ``streaming.bounded.with_event_time``.
    """
    rule = AVERAGE_SPEED_RULES[preset]
    at = lambda seg: (F.col("seg") == seg) & (F.col("pos") > 0)
    entry = F.struct(
        "pos", (-F.col("time").cast("long")).alias("neg_time"), (-F.col("seq")).alias("neg_seq"),
        "time", "xway", "dir",
    )
    exit_ = F.struct("pos", "time", "seq", "dir")
    trips = session_aggregate(
        rule.section(reports), "vid", "time", ARRIVAL, rule.gap_ticks if gap_ticks is None else gap_ticks,
        {
            "entry": ("min", F.when(at(filters.SECTION_FIRST), entry)),
            "exit": ("max", F.when(at(filters.SECTION_LAST), exit_)),
        },
        max_group_rows,
    )
    distance = F.col("exit.pos") - F.col("entry.pos")
    duration = F.col("exit.time") - F.col("entry.time")
    mph = exact_mph(distance, duration) if rule.exact else whole_mph(distance, duration)
    rounded = round_half_up(F.col("mph"))
    return (
        trips.where(F.col("entry.dir") == F.col("exit.dir"))
        .withColumn("mph", mph)
        .where((rounded if rule.compare_rounded else F.col("mph")) > limit)
        .select(
            F.col("entry.time").alias("time1"),
            F.col("exit.time").alias("time2"),
            "vid",
            F.col("entry.xway").alias("xway"),
            F.col("entry.dir").alias("dir"),
            (F.col("mph") if rule.exact else rounded).alias("avgspd"),
        )
    )


def accidents(
    reports: DataFrame, preset: str = "telematics", max_group_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """Vehicles that report one position four times in a row.

    ``(time1, time2, vid, xway, seg, dir, pos)``: the first of the four reports
    and the time of the last. Every further report at that position is one more
    row. Which reports follow each other is decided after the preset's filter.
    A stream with an event time (``streaming.bounded.with_event_time``) is walked in its order.
    """
    rule = ACCIDENT_RULES[preset]
    rows = filters.stopped(reports) if rule.stopped_only else reports
    if rows.isStreaming:
        from roadpulse.streaming.stateful import stream_accidents

        return stream_accidents(rows, rule.same_dir)
    same = ("pos", "dir") if rule.same_dir else ("pos",)
    first = ("time", "xway", "seg", "dir")
    previous = {f"{c}_{n}": (c, n) for c in same for n in (1, 2, 3)}
    previous |= {f"{c}_3": (c, 3) for c in first}
    rows = rows.select("vid", "time", "seq", "xway", "seg", "dir", "pos")
    four = reduce(and_, [F.col(f"{c}_{n}") == F.col(c) for c in same for n in (1, 2, 3)])
    return with_previous(rows, "vid", ARRIVAL, previous, max_group_rows, four).select(
        F.col("time_3").alias("time1"),
        F.col("time").alias("time2"),
        "vid",
        *[F.col(f"{c}_3").alias(c) for c in first[1:]],
        "pos",
    )
