"""Sources: text lines, strict CSV records, elements in memory; batch and stream."""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.operators.numbering import number_rows
from roadpulse.schemas import REPORT, REPORT_COMPACT, SENSOR

# Functions travel with the plan, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What the text of a field may look like; ranges are checked by the cast.
_FIELD = {T.IntegralType: r"[+-]?[0-9]+", T.DataType: "[^,]*"}
# monotonically_increasing_id: the partition above, the row within it in these bits.
_ROW_BITS = 33
# A table of more files than this is joined by a shuffle instead of a broadcast.
MOST_FILES_SENT = 500_000


def from_elements(spark: SparkSession, elements: Iterable[str]) -> DataFrame:
    """``(value, seq)`` from a few strings."""
    rows = [(value, i) for i, value in enumerate(elements)]
    return spark.createDataFrame(rows, "value string, seq long")


def read_lines(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """``value``, and on demand the arrival number ``seq``."""
    lines = spark.read.text(path)
    return with_arrival(lines, path) if numbered else lines


def numbered_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, place)``: the files below a path, numbered from 0 by name. Their contents are not read."""
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"))
    return number_rows(files, ["file"], "place")


def with_arrival(lines: DataFrame, path: str) -> DataFrame:
    """Lines of text files with their arrival number ``seq``: by file name, then by place in the file.

    In one number lie, from the top, the file's place by name, the block that a task
    reads (in units of the largest block), and the line within the task. Numbers are
    in order but not without gaps. More files or blocks than the bits hold fail.
    """
    spark = lines.sparkSession
    files = numbered_files(spark, path)
    n_files = files.count()
    block_bits = 63 - _ROW_BITS - max(1, (n_files - 1).bit_length())
    size = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    placed = lines.withColumns({
        "_file": F.col("_metadata.file_path"),
        "_block": F.floor(F.col("_metadata.file_block_start") / size),
        "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
    })
    files = F.broadcast(files) if n_files <= MOST_FILES_SENT else files
    placed = placed.join(files, F.col("_file") == F.col("file"), "left")
    fits = F.col("place").isNotNull() & (F.col("_block") < 1 << block_bits)
    number = F.shiftleft(F.shiftleft("place", block_bits) + F.col("_block"), _ROW_BITS) + F.col("_row")
    seq = F.when(fits, number).otherwise(F.raise_error(F.lit("too many blocks")).cast("long"))
    return placed.select(*lines.columns, seq.alias("seq"))


def read_reports(
    spark: SparkSession, path: str, compact: bool = False, lenient_columns: bool = False,
    numbered: bool = True,
) -> DataFrame:
    """Position reports, with their arrival number ``seq`` unless ``numbered`` is off.

    A malformed, missing, surplus or out-of-range field fails the query, whichever
    columns and rows it uses; blank lines are skipped. ``lenient_columns`` ignores
    surplus columns and rejects blank lines.
    """
    schema = REPORT_COMPACT if compact else REPORT
    return parse_records(read_lines(spark, path, numbered), schema, lenient_columns)


def read_sensor(
    spark: SparkSession, path: str, lenient_columns: bool = False, numbered: bool = True
) -> DataFrame:
    """Sensor readings, with their arrival number ``seq`` on demand; the id may be empty."""
    return parse_records(read_lines(spark, path, numbered), SENSOR, lenient_columns)


def parse_records(lines: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """Records from text lines ``value`` by plain splitting; other columns follow.

    A line is split once and its fields are cast once, behind generators of one row, which keep
    the optimizer from repeating them per use. The check of the line and of all casts is one
    condition above them; it uses every column, so no condition of a query gets ahead of it.
    """
    others = [c for c in lines.columns if c != "value"]
    split = F.struct(F.split("value", ",", -1).alias("_fields"), "value", *others)
    casts = [F.get("_fields", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    cast = lines.select(F.inline(F.array(split))).select(
        F.inline(F.array(F.struct(*casts, F.col("value").alias("_line"), *others)))
    )
    layout = ",".join(_layout(f.dataType) for f in schema.fields) + ("(,.*)?" if lenient else "")
    sound = F.col("_line").rlike(rf"(?s)\A{layout}\z")
    for f in schema.fields:
        sound = sound & F.col(f.name).isNotNull()
    error = F.raise_error(F.concat(F.lit("malformed record: "), "_line")).cast("boolean")
    keep = F.when(sound, True).otherwise(error)
    if not lenient:
        keep = F.when(F.trim("_line") == "", False).otherwise(keep)
    return cast.where(keep).select(*schema.names, *others)


def _layout(kind: T.DataType) -> str:
    return next(pattern for of, pattern in _FIELD.items() if isinstance(kind, of))


def stream_lines(spark: SparkSession, format: str = "text", **options: str) -> DataFrame:
    """Unbounded text lines ``value``.

    ``format="socket"`` takes ``host`` and ``port``; file formats take ``path``.
    """
    return spark.readStream.format(format).options(**options).load()


def stream_csv(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None,
    numbered: bool = False,
) -> DataFrame:
    """Records from a growing folder of CSV files, parsed as strictly as in batch.

    ``numbered`` adds ``seq``, a text that sorts as lines arrive: by the time of the file, its
    name, and the line's place in it. Without it, arrival numbers are part of the data
    (``schemas.with_seq``).
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.text(path)
    return parse_records(_numbered_as_they_come(lines) if numbered else lines, schema)


def _numbered_as_they_come(lines: DataFrame) -> DataFrame:
    """Files of a stream come by their modification time; a later one belongs to a later batch."""
    part = lambda number, digits: F.lpad(number.cast("string"), digits, "0")
    place = F.concat_ws(
        "/", part(F.unix_millis("_metadata.file_modification_time"), 15), F.col("_metadata.file_name"),
        part(F.col("_metadata.file_block_start"), 15),
    )
    numbered = lines.select("value", place.alias("place")).mapInArrow(
        _with_row_numbers, "value string, place string, row long"
    )
    return numbered.select("value", F.concat_ws("/", "place", part(F.col("row"), 11)).alias("seq"))


def _with_row_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the lines of a task, which reads a block of a file in order."""
    seen = 0
    for batch in batches:
        row = pa.array(range(seen, seen + len(batch)), pa.int64())
        seen += len(batch)
        yield pa.RecordBatch.from_arrays([*batch.columns, row], names=["value", "place", "row"])
