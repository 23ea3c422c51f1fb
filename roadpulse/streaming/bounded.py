"""Running streaming queries over bounded input, to the last row.

A stream in append mode gives a window or session out once the watermark has
passed its end, so after bounded input the last ones stay open. ``finalize``
closes them: a far-future sentinel record, in a folder of its own that the query
reads next to the real input, moves the watermark past every real record. The
sentinel's own window never closes, so it leaves no trace in the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadpulse.session import LEAN_DEFAULTS, STREAM_DEFAULTS, drop_folder

# Fixed value: how far an ascending watermark stays behind, so that equal times are in time.
ASCENDING = "1 millisecond"


def with_event_time(df: DataFrame, time: str, unit: str = "ms", delay: str = "0 seconds") -> DataFrame:
    """Adds ``event_time`` from a number (``ms`` or ``s``), with a watermark ``delay`` behind the
    latest. ``ASCENDING`` lets a time go on in the next micro-batch."""
    convert = {"ms": F.timestamp_millis, "s": F.timestamp_seconds}[unit]
    return df.withColumn("event_time", convert(F.col(time))).withWatermark("event_time", delay)


class BoundedInput:
    """A folder that grows by slices, read as a stream of Parquet files.

    Opened again, it goes on with what it holds.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root, schema
        self.input, self.end = f"{root}/input", f"{root}/end"
        for folder in (self.input, self.end):
            self._make(folder)

    def _make(self, folder: str) -> None:
        self.spark.createDataFrame([], self.schema).write.mode("ignore").parquet(folder)

    def stream(self) -> DataFrame:
        read = lambda folder: self.spark.readStream.schema(self.schema).parquet(folder)
        return read(self.input).unionByName(read(self.end))

    def append(self, rows: DataFrame) -> None:
        rows.select(*self.schema.fieldNames()).write.mode("append").parquet(self.input)

    def forget(self) -> None:
        """Drops what was appended; every query over it must have taken it."""
        drop_folder(self.spark, self.input)
        self._make(self.input)

    def finalize(self, sentinel: dict) -> None:
        row = tuple(sentinel.get(name) for name in self.schema.fieldNames())
        self.spark.createDataFrame([row], self.schema).write.mode("append").parquet(self.end)


def start_available(
    spark: SparkSession, writer: DataStreamWriter, state_partitions: int | None = None, lean: bool = False
) -> StreamingQuery:
    """Start a query that takes what has arrived and stops.

    The number of state partitions is fixed by the first start of a checkpoint;
    ``state_partitions`` sets it for this query alone. So are the settings of streams that
    ``session.build_session`` makes, which a session of another make may lack. ``lean`` keeps the
    state of the last two micro-batches instead of a hundred, and no other copies of it.
    """
    wanted = STREAM_DEFAULTS | (LEAN_DEFAULTS if lean else {})
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        return writer.trigger(availableNow=True).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def replay(
    source: BoundedInput,
    slices: list[DataFrame],
    build: Callable[[DataFrame], DataStreamWriter],
    sentinel: dict | None = None,
    state_partitions: int | None = None,
    lean: bool = False,
) -> None:
    """Feed the slices one after the other through one query (same checkpoint).

    The query runs once per slice, when the slice is complete: a query that is
    always on could see half of one and so break the order of arrival.
    ``sentinel`` comes with the last slice and closes what is open after it. ``lean`` drops a slice
    once it has been taken, and old state: then the disk holds little more than one slice.
    """
    for number, piece in enumerate(slices, 1):
        source.append(piece)
        if sentinel is not None and number == len(slices):
            source.finalize(sentinel)
        query = start_available(source.spark, build(source.stream()), state_partitions, lean)
        query.awaitTermination()
        if lean:
            source.forget()
