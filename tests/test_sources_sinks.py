import glob

import pytest
from conftest import rows
from pyspark.errors import AnalysisException

from roadpulse.plans.detectors import accidents, speed_fines
from roadpulse.schemas import REPORT, with_seq
from roadpulse.sources import readers, writers

GOOD = "1,7,95,3,0,1,52,500"


@pytest.fixture
def folder(tmp_path):
    def write(*lines):
        (tmp_path / "in.csv").write_text("\n".join(lines) + "\n")
        return str(tmp_path / "in.csv")

    return write


def text_of(path):
    return sorted(
        line for f in glob.glob(f"{path}/part-*") for line in open(f).read().splitlines()
    )


def test_reports(spark, folder):
    path = folder(GOOD, "2,7,0,3,4,1,53,600")
    for lenient in (False, True):
        df = readers.read_reports(spark, path, lenient_columns=lenient)
        assert rows(df) == [(1, 7, 95, 3, 0, 1, 52, 500, 0), (2, 7, 0, 3, 4, 1, 53, 600, 1)]
    assert [t for _, t in df.dtypes] == ["int"] * 8 + ["bigint"]
    compact = dict(readers.read_reports(spark, path, compact=True).dtypes)
    assert [compact[c] for c in ("xway", "dir", "seg", "pos")] == ["tinyint"] * 3 + ["int"]


@pytest.mark.parametrize(
    "line",
    ["x,7,95,3,0,1,52,500", "1,7,95,3,0,1,52", "1,7,95,3,0,1,,500", "1,7,95,3,0,1, 52,500",
     "1,7,95,3,0,1,5.2,500", "99999999999,7,95,3,0,1,52,500", '"1",7,95,3,0,1,52,500'],
)
@pytest.mark.parametrize("lenient", [False, True])
def test_malformed_record_fails(spark, folder, line, lenient):
    df = readers.read_reports(spark, folder(GOOD, line), lenient_columns=lenient)
    with pytest.raises(Exception):
        df.collect()


@pytest.mark.parametrize("line", ["2,7,50,3,0,x,52,500", "2,7,50,3", "2,7,50,3,0,,52,500", "2,7,50,3,0,99999999999,52,5"])
@pytest.mark.parametrize("lenient", [False, True])
@pytest.mark.parametrize(
    "use",
    [lambda d: d, lambda d: d.select("vid"), lambda d: d.groupBy().count(), speed_fines,
     lambda d: accidents(d, "opt", None), lambda d: d.where("spd > 1000").select("time")],
)
def test_malformed_record_fails_whatever_is_used(spark, folder, line, lenient, use):
    df = readers.read_reports(spark, folder(GOOD, line), lenient_columns=lenient)
    with pytest.raises(Exception, match="malformed record"):
        use(df).collect()


def test_stream_parses_as_strictly(spark, folder, tmp_path):
    folder(GOOD + ",1", "2,7,50,3,0,x,52,500,2")
    stream = readers.stream_csv(spark, f"{tmp_path}/*.csv", with_seq(REPORT)).select("vid")
    query = stream.writeStream.format("noop").trigger(availableNow=True)
    with pytest.raises(Exception, match="malformed record"):
        query.option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()


def test_arrival_order_over_files(spark, tmp_path):
    """The first file is the smaller one; Spark packs the larger one first."""
    (tmp_path / "a.csv").write_text("1,s,1.0\n2,s,1.0\n")
    (tmp_path / "b.csv").write_text("".join(f"{i},s,1.0\n" for i in range(3, 4003)))
    sensor = readers.read_sensor(spark, str(tmp_path / "*.csv"))
    assert [r.ts for r in sensor.orderBy("seq").select("ts").collect()] == list(range(1, 4003))
    assert [r.ts for r in readers.read_lines(spark, str(tmp_path), numbered=True).orderBy("seq")
            .selectExpr("cast(split(value, ',')[0] as int) ts").limit(3).collect()] == [1, 2, 3]


def test_plan_splits_a_line_once_and_names_no_files(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i:03}.csv").write_text(f"{i},s,1.0\n")
    sensor = readers.read_sensor(spark, str(tmp_path))
    plan = sensor.where("value > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count(".csv") < 3
    assert [r.ts for r in sensor.orderBy("seq").collect()] == list(range(300))


def test_byte_range(spark, folder):
    path = folder("1,7,95,3,0,1,200,500")
    assert readers.read_reports(spark, path).count() == 1
    for lenient in (False, True):
        with pytest.raises(Exception):
            readers.read_reports(spark, path, compact=True, lenient_columns=lenient).collect()


def test_surplus_columns(spark, folder):
    path = folder(GOOD + ",1,2,3")
    assert rows(readers.read_reports(spark, path, lenient_columns=True))[0][:8] == (
        1, 7, 95, 3, 0, 1, 52, 500,
    )
    with pytest.raises(Exception):
        readers.read_reports(spark, path).collect()


def test_sensor(spark, folder):
    path = folder("5,sensor1,2.5", "6,a b,1e3", '7,"q",-1')
    for lenient in (False, True):
        df = readers.read_sensor(spark, path, lenient_columns=lenient)
        assert rows(df) == [(5, "sensor1", 2.5, 0), (6, "a b", 1000.0, 1), (7, '"q"', -1.0, 2)]
    with pytest.raises(Exception):
        readers.read_sensor(spark, folder("5,a,", "6,b,1")).collect()
    for lenient in (False, True):
        empty = readers.read_sensor(spark, folder("5,,2.5"), lenient_columns=lenient)
        assert rows(empty) == [(5, "", 2.5, 0)]


def test_text_sink_creates_only(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    lines = readers.read_lines(spark, folder("a,b", 'c "d"', ""))
    writers.write_text(lines, out)
    assert text_of(out) == ["", "a,b", 'c "d"']
    with pytest.raises(AnalysisException):
        writers.write_text(lines, out)


def test_tuple_and_csv_sinks_overwrite(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, 'a "b"', 2.0), (2, " c", 0.1)], "x int, y string, z double")
    for _ in range(2):
        writers.write_tuple_text(df, out)
    assert text_of(out) == ['(1,a "b",2.0)', "(2, c,0.1)"]
    writers.write_csv(df, out)
    assert text_of(out) == ['1,a "b",2.0', "2, c,0.1"]


def test_single_file(spark, tmp_path):
    df = spark.range(1000, numPartitions=4)
    writers.write_csv(df, str(tmp_path / "many"))
    writers.write_csv(df, str(tmp_path / "one"), single_file=True)
    count = lambda name: len(glob.glob(str(tmp_path / name / "part-*")))
    assert (count("many"), count("one")) == (4, 1)


def test_console_prints_every_row(spark, capsys):
    writers.show(spark.createDataFrame([(f"word {i}",) for i in range(300)], "value string"))
    assert capsys.readouterr().out.count("(word ") == 300
