"""Record layouts: every record is a flat struct with named, typed columns."""

from pyspark.sql import types as T

REPORT_COLUMNS = ("time", "vid", "spd", "xway", "lane", "dir", "seg", "pos")
_COMPACT = {"xway", "dir", "seg"}

REPORT = T.StructType([T.StructField(c, T.IntegerType()) for c in REPORT_COLUMNS])
REPORT_COMPACT = T.StructType(
    [T.StructField(c, T.ByteType() if c in _COMPACT else T.IntegerType()) for c in REPORT_COLUMNS]
)
SENSOR = T.StructType(
    [
        T.StructField("ts", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def with_seq(schema: T.StructType) -> T.StructType:
    """The same layout followed by the arrival number ``seq``."""
    return T.StructType(schema.fields + [T.StructField("seq", T.LongType())])
