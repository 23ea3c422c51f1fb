"""Sinks: text, tuple text, CSV and console; batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def csv_lines(df: DataFrame) -> DataFrame:
    """``value`` = the fields joined by commas, without quoting."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(",", *fields).alias("value"))


def tuple_lines(df: DataFrame) -> DataFrame:
    """``value`` = the fields as ``(a,b,c)``."""
    return csv_lines(df).select(F.concat(F.lit("("), "value", F.lit(")")).alias("value"))


def write_text(
    df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False
) -> None:
    """Lines as they are; by default into a folder that must not exist yet.

    ``single_file`` writes everything in one task, so it suits small results; what comes
    before the writing stays parallel.
    """
    (df.repartition(1) if single_file else df).write.mode(mode).text(path)


def write_tuple_text(df: DataFrame, path: str, single_file: bool = False) -> None:
    write_text(tuple_lines(df), path, "overwrite", single_file)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    write_text(csv_lines(df), path, "overwrite", single_file)


def show(df: DataFrame) -> None:
    """Print every row as a tuple, one partition at a time."""
    for row in tuple_lines(df).toLocalIterator(prefetchPartitions=True):
        print(row["value"], flush=True)


def stream_console(df: DataFrame, output_mode: str = "append") -> DataStreamWriter:
    """Print every row of every micro-batch."""
    return df.writeStream.foreachBatch(lambda rows, _: show(rows)).outputMode(output_mode)


def stream_files(
    df: DataFrame, path: str, checkpoint: str, format: str = "parquet"
) -> DataStreamWriter:
    """Append-mode file sink; ``csv`` and ``tuple`` write unquoted text lines."""
    if format in ("csv", "tuple"):
        df, format = (csv_lines(df) if format == "csv" else tuple_lines(df)), "text"
    return (
        df.writeStream.format(format)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
