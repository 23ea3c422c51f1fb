"""Vehicle reports, sensor readings and text lines derived from the test tables.

``reports`` turns every event into one trip of 40 position reports of the
vehicle ``user_id``, one report per 30 time units; see FIXTURES.md. All of it is
row-wise, so the work grows with ``events`` and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Reports of a trip and the time from one to the next.
REPORTS, TICKS = 40, 30


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since 1970, whatever the session time zone is."""
    ts = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_seconds(ts)
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def trip_start(events: DataFrame) -> Column:
    """The time of the first report of an event's trip."""
    return (_epoch_seconds(events, "ts") - 1704067200).cast("int")


def reports_from_events(events: DataFrame) -> DataFrame:
    """``(seq, time, vid, spd, xway, lane, dir, seg, pos)``, batch or stream."""
    trips = events.select(
        "event_id",
        F.col("user_id").cast("int").alias("vid"),
        trip_start(events).alias("t0"),
        (F.floor("value").cast("int") % 40 + 10).alias("v"),
        (F.col("event_type") == "error").alias("stops"),
        (F.col("event_id") % 2).cast("int").alias("dir0"),
    )
    steps = trips.select("*", F.explode(F.sequence(F.lit(0), F.lit(REPORTS - 1))).alias("step"))
    moved = F.when(
        F.col("stops"), F.least("step", F.lit(10)) + F.greatest(F.col("step") - 15, F.lit(0))
    ).otherwise(F.col("step"))
    distance = F.col("v") * 30 * moved
    flipped = F.col("stops") & (F.col("step") == 13) & (F.col("event_id") % 3 == 0)
    placed = steps.select(
        (F.col("event_id") * 100 + F.col("step")).alias("seq"),
        (F.col("t0") + TICKS * F.col("step")).alias("time"),
        "vid",
        F.when(F.col("stops") & F.col("step").between(11, 15), 0)
        .otherwise(F.floor(F.col("v") * 2.2369 + 0.5).cast("int"))
        .alias("spd"),
        (F.col("vid") % 5).alias("xway"),
        (F.col("step") % 5).alias("lane"),
        F.when(flipped, 1 - F.col("dir0")).otherwise(F.col("dir0")).alias("dir"),
        F.when(F.col("dir0") == 0, 273280 + distance).otherwise(300960 - distance).alias("pos"),
    )
    return placed.select(
        "seq", "time", "vid", "spd", "xway", "lane", "dir",
        F.floor(F.col("pos") / 5280).cast("int").alias("seg"),
        "pos",
    )


def sensor_from_events(events: DataFrame) -> DataFrame:
    """``(ts, id, value, seq)``, batch or stream."""
    return events.select(
        _epoch_seconds(events, "ts").alias("ts"),
        F.col("event_type").alias("id"),
        "value",
        F.col("event_id").alias("seq"),
    )


def lines_from_documents(documents: DataFrame) -> DataFrame:
    """``(seq, value)``: every document is one text line."""
    return documents.select(F.col("doc_id").alias("seq"), F.col("text").alias("value"))


def reports(
    spark: SparkSession, sf_dir: str, partitions: int | None = None,
    low: int | None = None, high: int | None = None,
) -> DataFrame:
    """``partitions`` deals the events out before each becomes 40 reports; for few, large files.

    With ``low`` or ``high`` only the reports from ``low`` on and before ``high``; trips that lie
    outside are left out before they become reports.
    """
    events = _table(spark, sf_dir, "events")
    start = trip_start(events)
    if low is not None or high is not None:
        earliest = None if low is None else low - TICKS * (REPORTS - 1)
        events = events.where(within(start, earliest, high))
    made = reports_from_events(events.repartition(partitions, "event_id") if partitions else events)
    return made.where(within(F.col("time"), low, high))


def within(time: Column, low: int | None, high: int | None) -> Column:
    """From ``low`` on and before ``high``; without a ``low`` rows without a time are in it."""
    inside = F.lit(True) if high is None else time < high
    return inside | time.isNull() if low is None else inside & (time >= low)


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_from_events(_table(spark, sf_dir, "events"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from_documents(_table(spark, sf_dir, "documents"))
