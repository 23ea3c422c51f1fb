"""Whole jobs: read, compute, write. Each is also a command, see ``__main__``."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.functions.text import numbered_tokens, word_count
from roadpulse.operators.filters import above, fan_out, in_section
from roadpulse.operators.rolling import rolling, rolling_together
from roadpulse.operators.windows import sliding_sum
from roadpulse.plans.detectors import (
    AVERAGE_SPEED_RULES,
    SPEED_FINE_COLUMNS,
    accidents,
    average_speed_fines,
    speed_fines,
)
from roadpulse.session import drop_folder, scratch_dir
from roadpulse.sources import readers, writers
from roadpulse.streaming.stateful import stream_running_count

# The text the batch word count uses when it is given no file.
SAMPLE_LINES = (
    "To be, or not to be,--that is the question:--",
    "Whether 'tis nobler in the mind to suffer",
    "The slings and arrows of outrageous fortune",
    "Or to take arms against a sea of troubles,",
)

# Presets of the three detectors that make up one full job, and whether its speed
# fines are written as tuple text.
FULL_JOBS = {
    "telematics": ("radar", "telematics", "telematics", True),
    "opt": ("opt", "opt", "opt", False),
    "compact": ("compact", "compact", "compact", False),
}


@contextmanager
def shared(records: DataFrame, how: str = "table", key: str | None = None) -> Iterator[DataFrame]:
    """Make several readers of one parsed input parse it once.

    Keyed operators read twice, as they count their keys first. ``table`` stages
    the input as Parquet in the shared scratch folder: readers then take only
    their columns, their filters are pushed to the files, and it outlives lost
    executors. With a ``key`` it is staged in buckets of that key, a file each: one
    shuffle, and operators on the key need none any more. ``persist`` keeps it in
    executor memory and disk, which suits inputs of cluster-memory size. ``rescan``
    reads the source anew each time, best where the source is columnar already.
    Staged and persisted data go when the block ends.
    """
    spark = records.sparkSession
    if how == "table":
        path = scratch_dir(spark, "records")
        table = f"staged_{uuid.uuid4().hex}" if key else None
        try:
            yield _in_buckets(records, path, table, key) if key else _in_files(records, path)
        finally:
            if table:
                spark.sql(f"drop table if exists {table}")
            drop_folder(spark, path)
    elif how == "persist":
        kept = records.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield kept
        finally:
            kept.unpersist()
    elif how == "rescan":
        yield records
    else:
        raise ValueError(f"unknown way to share {how!r}")


def _in_files(records: DataFrame, path: str) -> DataFrame:
    records.write.mode("overwrite").parquet(path)
    return records.sparkSession.read.schema(records.schema).parquet(path)


def _in_buckets(records: DataFrame, path: str, table: str, key: str) -> DataFrame:
    spark = records.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = records.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).option("path", path).saveAsTable(table, format="parquet")
    return spark.table(table)


def telematics(
    reports: DataFrame, out: str, preset: str = "telematics", single_file: bool = False,
    sharing: str = "table",
) -> None:
    """Speed fines, average-speed fines and accidents of one input into three folders.

    Staged input (``sharing="table"``) lies in buckets of the vehicle, which the last two share.
    """
    fines, average, stuck, as_tuples = FULL_JOBS[preset]
    folder = out.rstrip("/")
    write_fines = writers.write_tuple_text if as_tuples else writers.write_csv
    with shared(reports, sharing, "vid") as rows:
        write_fines(speed_fines(rows, fines), f"{folder}/speedfines.csv", single_file)
        writers.write_csv(
            average_speed_fines(rows, average), f"{folder}/avgspeedfines.csv", single_file
        )
        writers.write_csv(accidents(rows, stuck), f"{folder}/accidents.csv", single_file)


# The folder and the columns of each kind of finding of a full job.
_FOLDERS = {"speed": "speedfines", "average": "avgspeedfines", "accident": "accidents"}


def _layouts(preset: str) -> dict[str, tuple[tuple[str, ...], dict[str, str]]]:
    """Per kind of finding its columns as written, and which of them ``all_findings`` renames."""
    return {
        "speed": (SPEED_FINE_COLUMNS[FULL_JOBS[preset][0]], {"time": "time1", "spd": "speed"}),
        "average": (("time1", "time2", "vid", "xway", "dir", "avgspd"), {"avgspd": "speed"}),
        "accident": (("time1", "time2", "vid", "xway", "seg", "dir", "pos"), {}),
    }


def stream_telematics(
    reports: DataFrame, out: str, checkpoint: str, preset: str = "telematics"
) -> DataStreamWriter:
    """The full job on a stream of reports with an event time: one query, three results.

    Each micro-batch writes its findings below ``speedfines.csv``, ``avgspeedfines.csv`` and
    ``accidents.csv`` into folders named after its number, so a batch that is run again
    after a failure half way overwrites what it had written.
    """
    folder, as_tuples = out.rstrip("/"), FULL_JOBS[preset][3]
    found = all_findings(reports, preset)
    types = _written_types(preset)

    def store(findings: DataFrame, batch: int) -> None:
        findings.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for kind, (columns, renamed) in _layouts(preset).items():
                own = findings.where(F.col("kind") == kind).select(
                    *[F.col(renamed.get(c, c)).cast(types.get(c, "int")).alias(c) for c in columns]
                )
                tuples = as_tuples and kind == "speed"
                lines = writers.tuple_lines(own) if tuples else writers.csv_lines(own)
                writers.write_text(lines, f"{folder}/{_FOLDERS[kind]}.csv/batch={batch}", "overwrite")
        finally:
            findings.unpersist()

    return found.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def _written_types(preset: str) -> dict[str, str]:
    return {"avgspd": "double" if AVERAGE_SPEED_RULES[FULL_JOBS[preset][1]].exact else "int"}


def all_findings(reports: DataFrame, preset: str = "telematics") -> DataFrame:
    """The three results of a full job in one table, told apart by ``kind``."""
    fines, average, stuck, _ = FULL_JOBS[preset]
    none = lambda name: F.lit(None).cast("int").alias(name)
    d1 = speed_fines(reports, fines)
    parts = [
        d1.select(
            F.lit("speed").alias("kind"), F.col("time").alias("time1"), none("time2"), "vid",
            F.col("xway").cast("int").alias("xway"),
            F.col("seg").cast("int").alias("seg"),
            F.col("dir").cast("int").alias("dir") if "dir" in d1.columns else none("dir"),
            F.col("pos") if "pos" in d1.columns else none("pos"),
            F.col("spd").cast("double").alias("speed"),
        ),
        average_speed_fines(reports, average).select(
            F.lit("average").alias("kind"), "time1", "time2", "vid",
            F.col("xway").cast("int").alias("xway"), none("seg"),
            F.col("dir").cast("int").alias("dir"), none("pos"),
            F.col("avgspd").cast("double").alias("speed"),
        ),
        accidents(reports, stuck).select(
            F.lit("accident").alias("kind"), "time1", "time2", "vid",
            F.col("xway").cast("int").alias("xway"),
            F.col("seg").cast("int").alias("seg"),
            F.col("dir").cast("int").alias("dir"), "pos",
            F.lit(None).cast("double").alias("speed"),
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def findings_of(spark: SparkSession, out: str, preset: str = "telematics") -> DataFrame:
    """What ``telematics`` or ``stream_telematics`` wrote below ``out``, as the table of ``all_findings``."""
    parts = []
    for kind, (columns, renamed) in _layouts(preset).items():
        text = readers.read_lines(spark, f"{out.rstrip('/')}/{_FOLDERS[kind]}.csv").select("value")
        if kind == "speed" and FULL_JOBS[preset][3]:
            text = text.select(F.expr("substring(value, 2, length(value) - 2)").alias("value"))
        at = {renamed.get(c, c): i for i, c in enumerate(columns)}
        field = lambda c: F.get(F.split("value", ","), F.lit(at[c])) if c in at else F.lit(None)  # noqa: B023, E731
        parts.append(text.select(
            F.lit(kind).alias("kind"),
            *(field(c).cast("int").alias(c) for c in ("time1", "time2", "vid", "xway", "seg", "dir", "pos")),
            field("speed").cast("double").alias("speed"),
        ))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def copy_lines(spark: SparkSession, source: str, out: str) -> None:
    writers.write_text(readers.read_lines(spark, source), out)


def filter_sensor(spark: SparkSession, source: str, out: str) -> None:
    kept = above(readers.read_sensor(spark, source)).select("ts", "id", "value")
    writers.write_tuple_text(kept, out)


def fan_out_sensor(spark: SparkSession, source: str, out: str) -> None:
    rows = fan_out(readers.read_sensor(spark, source)).select("ts", "id", "value")
    writers.write_csv(rows, out)


def reduce_sensor(spark: SparkSession, source: str, out: str) -> None:
    with shared(readers.read_sensor(spark, source)) as readings:
        writers.write_csv(rolling(readings, "reduce").select("ts", "id", "value"), out)


def rolling_sensor(spark: SparkSession, source: str, out: str | None = None) -> None:
    """Running minimum, maximum and sum: into folders below ``out``, or else printed."""
    with shared(readers.read_sensor(spark, source)) as readings:
        with shared(rolling_together(readings, ("min", "max", "sum"))) as running:
            for kind in ("min", "max", "sum"):
                rows = running.select("ts", "id", F.col(kind).alias("value"))
                _print_or_write(rows, out and f"{out.rstrip('/')}/{kind}")


def _print_or_write(rows: DataFrame, out: str | None) -> None:
    if out:
        writers.write_tuple_text(rows, out)
    else:
        writers.show(rows)


def sliding_sensor(spark: SparkSession, source: str, out: str) -> None:
    sums = sliding_sum(readers.read_sensor(spark, source))
    writers.write_csv(sums.select("ts", "id", "value"), out)


def radar(spark: SparkSession, source: str, out: str) -> None:
    fines = speed_fines(readers.read_reports(spark, source), "radar")
    writers.write_tuple_text(fines, f"{out.rstrip('/')}/speedfines.csv")


def average_speed(spark: SparkSession, source: str, out: str) -> None:
    needed = ("time", "vid", "xway", "seg", "dir", "pos", "seq")
    section = in_section(readers.read_reports(spark, source)).select(*needed)
    with shared(section) as reports:
        writers.write_csv(average_speed_fines(reports, "section60"), out)


def find_accidents(spark: SparkSession, source: str, out: str) -> None:
    needed = ("time", "vid", "xway", "seg", "dir", "pos", "seq")
    with shared(readers.read_reports(spark, source).select(*needed)) as reports:
        writers.write_csv(accidents(reports, "telematics"), out)


def full(preset: str) -> Callable[[SparkSession, str, str], None]:
    def run(spark: SparkSession, source: str, out: str, single_file: bool = False) -> None:
        reports = readers.read_reports(spark, source, compact=preset == "compact")
        telematics(reports, out, preset, single_file)

    return run


def count_words(spark: SparkSession, source: str | None = None, out: str | None = None) -> None:
    """How often each word occurs in a file or in the sample lines; all words, printed or written."""
    lines = readers.read_lines(spark, source) if source else readers.from_elements(spark, SAMPLE_LINES)
    _print_or_write(word_count(lines), out)


def running_words(lines: DataFrame) -> DataFrame:
    """``(word, count)`` per token of a text stream, how often its word was seen so far.

    Lines come in arrival order: a line's number is the time of its micro-batch.
    """
    numbered = numbered_tokens(lines.withColumn("seq", F.unix_micros(F.current_timestamp())))
    return stream_running_count(numbered, "word", ("seq", "pos")).select("word", "count")


def count_words_of_socket(spark: SparkSession, host: str, port: str) -> StreamingQuery:
    """Print each word of a socket's text with its running count until stopped."""
    lines = readers.stream_lines(spark, "socket", host=host, port=port)
    return writers.stream_console(running_words(lines)).start()
