import glob
import os

import pytest
from pyspark.errors import StreamingQueryException

from roadpulse import views
from roadpulse.__main__ import main, parser
from roadpulse.plans import jobs
from roadpulse.plans.detectors import accidents, average_speed_fines, speed_fines
from roadpulse.schemas import REPORT_COLUMNS
from roadpulse.sources import readers, writers
from roadpulse.streaming.bounded import (
    ASCENDING,
    BoundedInput,
    start_available,
    with_event_time,
)


def lines_of(path):
    return sorted(
        line for f in glob.glob(f"{path}/part-*") for line in open(f).read().splitlines()
    )


def expected_lines(df, tuples=False):
    values = (",".join(map(str, r)) for r in df.collect())
    return sorted(f"({v})" if tuples else v for v in values)


@pytest.fixture(scope="module")
def source(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("jobs") / "reports")
    reports = views.reports(spark, sf).where("vid < 8").orderBy("time", "seq")
    writers.write_csv(reports.select(*REPORT_COLUMNS), path, single_file=True)
    return path


@pytest.mark.parametrize("job, preset", [
    ("telematics", "telematics"), ("telematics-opt", "opt"), ("telematics-compact", "compact"),
])
def test_full_job(spark, source, tmp_path, job, preset):
    main([job, source, str(tmp_path), "--single-file"])
    reports = readers.read_reports(spark, source, compact=preset == "compact")
    fines = "radar" if preset == "telematics" else preset
    for name, df, tuples in (
        ("speedfines", speed_fines(reports, fines), preset == "telematics"),
        ("avgspeedfines", average_speed_fines(reports, preset), False),
        ("accidents", accidents(reports, preset), False),
    ):
        got = lines_of(tmp_path / f"{name}.csv")
        assert got and got == expected_lines(df, tuples), name


@pytest.mark.parametrize("sharing", ["persist", "rescan"])
def test_other_ways_of_sharing(spark, source, tmp_path, sharing):
    reports = readers.read_reports(spark, source)
    jobs.telematics(reports, str(tmp_path), "opt", sharing=sharing)
    assert lines_of(tmp_path / "accidents.csv") == expected_lines(accidents(reports, "opt"))
    with pytest.raises(ValueError), jobs.shared(reports, "hope"):
        pass


def test_staged_table_is_read_by_columns_and_dropped(spark, source):
    with jobs.shared(readers.read_reports(spark, source)) as rows:
        (path,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in rows.inputFiles()}
        plan = speed_fines(rows)._jdf.queryExecution().toString()
        assert os.path.isdir(path) and "GreaterThan(spd,90)" in plan
    assert not os.path.exists(path)


def test_keyed_detectors_share_the_staged_buckets(spark, source):
    with jobs.shared(readers.read_reports(spark, source), key="vid") as rows:
        for found in (average_speed_fines(rows), accidents(rows)):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan, plan
        (table,) = [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    assert not spark.catalog.tableExists(table)


def test_streaming_job_survives_a_sink_that_fails_half_way(spark, sf, tmp_path, monkeypatch):
    reports = views.reports(spark, sf).where("vid < 8")
    source = BoundedInput(spark, str(tmp_path / "s"), reports.schema)
    out, failed = str(tmp_path / "out"), []
    write = writers.write_text

    def failing(lines, path, *args):
        write(lines, path, *args)
        if "avgspeedfines" in path and path.endswith("batch=1") and not failed:
            failed.append(path)
            raise OSError("disk full")

    monkeypatch.setattr(writers, "write_text", failing)

    def run():
        stream = with_event_time(source.stream(), "time", delay=ASCENDING)
        writer = jobs.stream_telematics(stream, out, str(tmp_path / "checkpoint"), "compact")
        start_available(spark, writer, 2).awaitTermination()

    middle = reports.agg({"time": "avg"}).first()[0]
    for piece in (reports.where(f"time < {middle}"), reports.where(f"time >= {middle}")):
        source.append(piece)
        try:
            run()
        except StreamingQueryException:
            run()
    source.finalize({"vid": -1, "time": 2**31 - 1, "seq": 0, "spd": 0, "xway": 0, "lane": 0, "dir": 0,
                     "seg": 52, "pos": 274560})
    run()
    assert failed
    got = sorted(map(str, jobs.findings_of(spark, out, "compact").collect()))
    assert got == sorted(map(str, jobs.all_findings(reports, "compact").collect()))


def test_single_detectors(spark, source, tmp_path):
    reports = readers.read_reports(spark, source)
    main(["radar", source, str(tmp_path)])
    main(["average-speed", source, str(tmp_path / "average")])
    main(["accidents", source, str(tmp_path / "accidents")])
    assert lines_of(tmp_path / "speedfines.csv") == expected_lines(speed_fines(reports), True)
    assert lines_of(tmp_path / "average") == expected_lines(average_speed_fines(reports, "section60"))
    assert lines_of(tmp_path / "accidents") == expected_lines(accidents(reports))


def test_sensor_jobs(spark, tmp_path, capfd):
    source = tmp_path / "s.csv"
    source.write_text("3,sensor1,30.0\n1,b,5.0\n4,sensor1,10.5\n")
    out = lambda name: str(tmp_path / name)
    main(["copy-lines", str(source), out("copy")])
    assert lines_of(out("copy")) == ["1,b,5.0", "3,sensor1,30.0", "4,sensor1,10.5"]
    main(["filter-sensor", str(source), out("filter")])
    assert lines_of(out("filter")) == ["(3,sensor1,30.0)"]
    main(["fan-out-sensor", str(source), out("fan")])
    assert lines_of(out("fan")) == [
        "3,sensor1,1.0", "3,sensor1,30.0", "3,this is a string test,134.0",
        "4,sensor1,1.0", "4,sensor1,10.5", "4,this is a string test,134.0",
    ]
    main(["reduce-sensor", str(source), out("reduce")])
    assert lines_of(out("reduce")) == ["1,b,5.0", "3,sensor1,30.0", "4,sensor1,40.5"]
    main(["sliding-sensor", str(source), out("sliding")])
    assert lines_of(out("sliding")) == sorted(
        ["1,b,5.0"] * 3 + ["3,sensor1,30.0", "4,sensor1,40.5", "4,sensor1,40.5", "4,sensor1,10.5"]
    )
    capfd.readouterr()
    main(["rolling-sensor", str(source)])
    printed = capfd.readouterr().out
    assert printed.count("sensor1") == 6 and "40.5" in printed


def test_word_count_job(spark, tmp_path, capfd):
    main(["word-count"])
    assert "(question,1)" in capfd.readouterr().out
    (tmp_path / "t.txt").write_text("fox fox " + " ".join(f"word{i}" for i in range(30)))
    main(["word-count", str(tmp_path / "t.txt")])
    printed = capfd.readouterr().out
    assert "(fox,2)" in printed and printed.count("(word") == 30
    main(["word-count", str(tmp_path / "t.txt"), str(tmp_path / "words")])
    assert len(lines_of(tmp_path / "words")) == 31


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        parser().parse_args(["socket-word-count", "localhost"])
    with pytest.raises(SystemExit):
        parser().parse_args(["telematics", "only-a-source"])
    assert parser().parse_args(["socket-word-count", "localhost", "9999"]).port == "9999"
