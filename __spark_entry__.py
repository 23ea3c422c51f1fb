"""Queries of the library over the test tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import views
from roadpulse.functions.text import numbered_tokens, running_word_count, word_count
from roadpulse.operators.filters import above, fan_out
from roadpulse.operators.rolling import rolling
from roadpulse.operators.windows import sliding_sum
from roadpulse.plans.detectors import accidents, average_speed_fines, speed_fines
from roadpulse.plans.jobs import all_findings, findings_of, stream_telematics, telematics
from roadpulse.schemas import REPORT_COLUMNS
from roadpulse.schemas import SENSOR as SENSOR_RECORD
from roadpulse.session import scratch_dir
from roadpulse.sources import readers, writers
from roadpulse.streaming.bounded import (
    ASCENDING,
    BoundedInput,
    replay,
    start_available,
    with_event_time,
)
from roadpulse.streaming.stateful import stream_rolling, stream_running_count

try:  # the training-data operators are optional and come and go together
    import corpus_pipeline
    from roadpulse.llm import registry as training_data
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "roadpulse.llm", "roadpulse.llm.registry"):
        raise
    training_data = None

COMPACT = ("xway", "dir", "seg")
# A stream is fed in slices of time, as many as there are rows for, within these bounds: the disk
# holds one slice, but rows that are not cut before they are made are read once per slice.
SLICES, MOST_SLICES = 2, 16
SLICE_ROWS = 32_000_000
# Characters of a token and what separates it from the next; an estimate.
TOKEN_LENGTH = 6
# The "split" queries cut every key with more rows than this, as hot keys are cut.
SPLIT_ROWS = 1000
# Events, of 40 reports each, that one task turns into reports.
EVENTS_PER_TASK = 50_000


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: average-speed fines on /root/testdata/sf0.001."""
    return average_speed_fines(views.reports(spark, "/root/testdata/sf0.001"), "telematics")


# --- Spark side -------------------------------------------------------------


def _all_reports(spark: SparkSession, sf: str) -> DataFrame:
    return views.reports(spark, sf, _tasks(spark, spark.read.parquet(f"{sf}/events.parquet").count()))


def _tasks(spark: SparkSession, events: int) -> int:
    """The test tables are single files: dealt out first, all cores make reports. The tasks are as many
    as the events ask for, so that none has more to sort the larger the table is."""
    return max(spark.sparkContext.defaultParallelism, -(-events // EVENTS_PER_TASK))


def _compact(reports: DataFrame) -> DataFrame:
    return reports.withColumns({c: F.col(c).cast("byte") for c in COMPACT})


def _reports(spark: SparkSession, sf: str, preset: str = "telematics") -> DataFrame:
    reports = _all_reports(spark, sf)
    return _compact(reports) if preset == "compact" else reports


def _speed_fines(preset: str):
    return lambda spark, sf: speed_fines(_reports(spark, sf, preset), preset)


def _rounded(df: DataFrame, name: str) -> DataFrame:
    """Doubles are compared to six decimals, whole numbers as they are."""
    is_double = dict(df.dtypes)[name] == "double"
    return df.withColumn(name, F.round(name, 6)) if is_double else df


def _average_speed(preset: str):
    return lambda spark, sf: _rounded(
        average_speed_fines(_reports(spark, sf, preset), preset), "avgspd"
    )


def _accidents(preset: str):
    return lambda spark, sf: accidents(_reports(spark, sf, preset), preset)


def _job(preset: str, sharing: str):
    """The full job into a scratch folder, and its three outputs read back as one table."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = scratch_dir(spark, "job")
        telematics(_reports(spark, sf, preset), out, preset, sharing=sharing)
        return _rounded(findings_of(spark, out, preset), "speed")

    return run


def _findings(preset: str):
    return lambda spark, sf: _rounded(all_findings(_reports(spark, sf, preset), preset), "speed")


def _rolling(kind: str):
    return lambda spark, sf: _rounded(rolling(views.sensor(spark, sf), kind), "value")


def _sliding(size: int, slide: int):
    return lambda spark, sf: _rounded(sliding_sum(views.sensor(spark, sf), size, slide), "value")


def _parse(compact: bool, lenient_columns: bool = False):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = scratch_dir(spark, "parse")
        writers.write_csv(_all_reports(spark, sf).select(*REPORT_COLUMNS), path)
        return readers.read_reports(spark, path, compact, lenient_columns, numbered=False)

    return run


def _line_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'lines')}/lines"
    lines = writers.csv_lines(_all_reports(spark, sf).select(*REPORT_COLUMNS))
    writers.write_text(lines, path)
    return readers.read_lines(spark, path)


def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    writers.write_csv(views.sensor(spark, sf).select("ts", "id", "value"), path)
    return readers.read_sensor(spark, path, numbered=False)


def _reduce_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """The sensor view by time ranges in several CSV files, read in arrival order and reduced."""
    path = scratch_dir(spark, "files")
    sensor = views.sensor(spark, sf)
    by_time = sensor.repartitionByRange(5, "ts", "seq").sortWithinPartitions("ts", "seq")
    writers.write_csv(by_time.select("ts", "id", "value"), path)
    return _rounded(rolling(readers.read_sensor(spark, path), "reduce").drop("seq"), "value")


def _tuple_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "tuples")
    writers.write_tuple_text(speed_fines(_all_reports(spark, sf)), path)
    return readers.read_lines(spark, path)


def _ranges(rows: DataFrame, time: Column, size: Column | int, longest: int = 0) -> list[tuple]:
    """Ranges of ``time`` with about as many rows each, as (first time, time after the last), open
    at both ends. ``size`` is what a row counts for, ``longest`` how long it may go on."""
    shares = [i / MOST_SLICES for i in range(1, MOST_SLICES)]
    low, high, total, at = rows.agg(
        F.min(time), F.max(time), F.sum(F.lit(size)), F.percentile_approx(time, F.array(*map(F.lit, shares)))
    ).first()
    if low is None:
        return [(None, None)]
    n = min(MOST_SLICES, -(-int(total or 0) // SLICE_ROWS))
    if n <= SLICES:
        wide = (high + longest - low) // SLICES + 1
        cuts = [low + i * wide for i in range(1, SLICES)]
    else:
        cuts = sorted({at[i * MOST_SLICES // n - 1] for i in range(1, n)})
    return list(zip([None, *cuts], [*cuts, None]))


def _slices(rows: DataFrame, time: str, size: Column | int = 1) -> list[DataFrame]:
    """By ranges of ``time``; rows without one are in the first."""
    return [rows.where(views.within(F.col(time), *r)) for r in _ranges(rows, F.col(time), size)]


def _report_slices(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All reports by ranges of their time; each slice makes its own from the trips that reach into it."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    ranges = _ranges(events, views.trip_start(events), views.REPORTS, views.TICKS * (views.REPORTS - 1))
    tasks = _tasks(spark, events.count() // len(ranges))
    return [views.reports(spark, sf, tasks, *r) for r in ranges]


def _through_stream(spark, label, slices, operator, sentinel) -> DataFrame:
    """Feed rows in slices of their time through ``operator`` and return what came out."""
    root = scratch_dir(spark, label)
    source = BoundedInput(spark, root, slices[0].schema)
    built = {}

    def build(stream: DataFrame):
        result = operator(stream)
        built["schema"] = result.schema
        return writers.stream_files(result, f"{root}/out", f"{root}/checkpoint")

    replay(source, slices, build, sentinel, spark.sparkContext.defaultParallelism, lean=True)
    return spark.read.schema(built["schema"]).parquet(f"{root}/out")


END_OF_REPORTS = {"vid": -1, "time": 2**31 - 1, "seq": 0, "spd": 0, "xway": 0, "lane": 0, "dir": 0,
                  "seg": 52, "pos": 274560}
END_OF_READINGS = {"ts": 4102444800, "id": "end of input", "value": 0.0, "seq": 0}


def _stream_accidents(spark: SparkSession, sf: str) -> DataFrame:
    return _through_stream(
        spark, "stream-accidents", _report_slices(spark, sf),
        lambda stream: accidents(with_event_time(stream, "time", delay=ASCENDING)), END_OF_REPORTS,
    )


def _stream_avg_speed(spark: SparkSession, sf: str) -> DataFrame:
    return _through_stream(
        spark, "stream-average", _report_slices(spark, sf),
        lambda stream: average_speed_fines(with_event_time(stream, "time")), END_OF_REPORTS,
    )


def _stream_sliding(size: int, slide: int, panes: bool = False):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        result = _through_stream(
            spark, "stream-sliding", _slices(views.sensor(spark, sf), "ts"),
            lambda stream: sliding_sum(with_event_time(stream, "ts", "s"), size, slide, panes),
            END_OF_READINGS,
        )
        return _rounded(result, "value")

    return run


def _stream_rolling_sum(spark: SparkSession, sf: str) -> DataFrame:
    result = _through_stream(
        spark, "stream-rolling", _slices(views.sensor(spark, sf), "ts"),
        lambda stream: stream_rolling(with_event_time(stream, "ts", "s", ASCENDING), "sum"), END_OF_READINGS,
    )
    return _rounded(result, "value")


def _stream_accidents_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Without an event time: reports are taken in arrival order, micro-batch by micro-batch."""
    return _through_stream(spark, "batch-accidents", _report_slices(spark, sf), accidents, None)


def _stream_rolling_sum_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    result = _through_stream(
        spark, "batch-rolling", _slices(views.sensor(spark, sf), "ts"),
        lambda stream: stream_rolling(stream, "sum"), None,
    )
    return _rounded(result, "value")


def _stream_running_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in order of their number, which is their event time."""
    end = {"seq": 2**40, "value": "end"}
    return _through_stream(
        spark, "stream-tokens", _slices(views.lines(spark, sf), "seq", F.length("value") / TOKEN_LENGTH),
        lambda stream: stream_running_count(
            numbered_tokens(with_event_time(stream, "seq", delay=ASCENDING), also=("event_time",)),
            "word", ("seq", "pos"),
        ),
        end,
    )


def _stream_telematics_job(spark: SparkSession, sf: str) -> DataFrame:
    """The full job on a stream; its three outputs read back as one table."""
    root, slices = scratch_dir(spark, "stream-job"), _report_slices(spark, sf)
    source = BoundedInput(spark, root, slices[0].schema)

    def build(stream: DataFrame):
        timed = with_event_time(stream, "time", delay=ASCENDING)
        return stream_telematics(timed, f"{root}/out", f"{root}/checkpoint")

    replay(source, slices, build, END_OF_REPORTS, spark.sparkContext.defaultParallelism, lean=True)
    return findings_of(spark, f"{root}/out")


def _stream_reduce_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """The sensor view as CSV files without arrival numbers, which arrive in two runs."""
    root, sensor = scratch_dir(spark, "stream-files"), views.sensor(spark, sf)
    folder = f"{root}/in"

    def append(readings: DataFrame) -> None:
        in_order = readings.repartitionByRange(3, "ts", "seq").sortWithinPartitions("ts", "seq")
        writers.write_text(writers.csv_lines(in_order.select("ts", "id", "value")), folder, "append")

    def run() -> None:
        stream = with_event_time(readers.stream_csv(spark, folder, SENSOR_RECORD, numbered=True), "ts", "s", ASCENDING)
        writer = writers.stream_files(stream_rolling(stream, "reduce"), f"{root}/out", f"{root}/checkpoint")
        start_available(spark, writer, spark.sparkContext.defaultParallelism).awaitTermination()

    end = spark.createDataFrame([tuple(END_OF_READINGS.values())], "ts long, id string, value double, seq long")
    for piece in (*_slices(sensor, "ts"), end):
        append(piece)
        run()
    reduced = spark.read.schema("ts long, id string, value double, seq string").parquet(f"{root}/out")
    return _rounded(reduced.drop("seq"), "value")


def _stream_word_count(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_dir(spark, "stream-words")
    lines = views.lines(spark, sf)
    source = BoundedInput(spark, root, lines.schema)

    def store(counts: DataFrame, batch: int) -> None:
        counts.write.mode("overwrite").parquet(f"{root}/out/batch={batch}")

    def build(stream: DataFrame):
        writer = word_count(stream).writeStream.outputMode("update").foreachBatch(store)
        return writer.option("checkpointLocation", f"{root}/checkpoint")

    slices = [lines.where(F.coalesce(F.pmod("seq", F.lit(SLICES)), F.lit(0)) == i) for i in range(SLICES)]
    replay(source, slices, build, None, spark.sparkContext.defaultParallelism)
    updates = spark.read.schema("word string, count long, batch long").parquet(f"{root}/out")
    return updates.groupBy("word").agg(F.max("count").alias("count"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name -> query over the tables in a folder."""
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for preset in ("radar", "opt", "compact"):
        out[f"speed_fines_{preset}"] = _speed_fines(preset)
    for preset in ("section60", "telematics", "opt", "compact"):
        out[f"avg_speed_{preset}"] = _average_speed(preset)
    for preset in ("telematics", "opt", "compact"):
        out[f"accidents_{preset}"] = _accidents(preset)
    out["telematics_job"] = _job("telematics", "table")
    out["telematics_job_opt"] = _job("opt", "persist")
    out["telematics_job_compact"] = _job("compact", "rescan")
    out["telematics_findings"] = _findings("telematics")
    out["sensor_filter"] = lambda spark, sf: above(views.sensor(spark, sf))
    out["sensor_fanout"] = lambda spark, sf: fan_out(views.sensor(spark, sf), "click")
    for kind in ("min", "max", "sum"):
        out[f"rolling_{kind}"] = _rolling(kind)
    out["keyed_reduce"] = _rolling("reduce")
    out["sliding_sum"] = _sliding(3, 1)
    out["sliding_sum_wide"] = _sliding(3600, 600)
    out["sliding_sum_long"] = _sliding(3600, 60)
    out["word_count"] = lambda spark, sf: word_count(views.lines(spark, sf))
    out["running_word_count"] = lambda spark, sf: running_word_count(views.lines(spark, sf))
    out["report_parse"] = _parse(compact=False)
    out["report_parse_compact"] = _parse(compact=True)
    out["report_parse_lenient"] = _parse(compact=False, lenient_columns=True)
    out["line_roundtrip"] = _line_roundtrip
    out["csv_roundtrip"] = _csv_roundtrip
    out["tuple_text"] = _tuple_text
    out["accidents_split"] = lambda spark, sf: accidents(
        _all_reports(spark, sf), "telematics", SPLIT_ROWS
    )
    out["avg_speed_split"] = lambda spark, sf: average_speed_fines(
        _all_reports(spark, sf), "telematics", max_group_rows=SPLIT_ROWS
    )
    out["rolling_sum_split"] = lambda spark, sf: _rounded(
        rolling(views.sensor(spark, sf), "sum", max_group_rows=SPLIT_ROWS), "value"
    )
    out["running_word_count_split"] = lambda spark, sf: running_word_count(
        views.lines(spark, sf), max_group_rows=SPLIT_ROWS
    )
    out["keyed_reduce_files"] = _reduce_of_files
    out["stream_running_word_count"] = _stream_running_word_count
    out["stream_accidents"] = _stream_accidents
    out["stream_avg_speed"] = _stream_avg_speed
    out["stream_sliding_sum"] = _stream_sliding(3, 1)
    out["stream_sliding_sum_wide"] = _stream_sliding(3600, 600, panes=True)
    out["stream_rolling_sum"] = _stream_rolling_sum
    out["stream_word_count"] = _stream_word_count
    out["stream_accidents_by_batch"] = _stream_accidents_by_batch
    out["stream_rolling_sum_by_batch"] = _stream_rolling_sum_by_batch
    out["stream_telematics_job"] = _stream_telematics_job
    out["stream_keyed_reduce_files"] = _stream_reduce_of_files
    if training_data:
        out |= training_data.queries() | {"pipeline": corpus_pipeline.run}
    return out


# --- SQL side ---------------------------------------------------------------

REPORTS = """
e as (select event_id, cast(user_id as int) vid,
             cast(floor(epoch(ts)) - 1704067200 as int) t0,
             10 + (cast(floor(value) as int) % 40) v,
             event_type = 'error' stops, cast(event_id % 2 as int) dir0
      from events),
r as (select e.*, step from e cross join (select cast(range as int) step from range(40)) s),
p as (select *, case when stops then least(step, 10) + greatest(step - 15, 0) else step end moved
      from r),
q as (select event_id * 100 + step seq, t0 + 30 * step as time, vid,
             case when stops and step between 11 and 15 then 0
                  else cast(floor(v * 2.2369 + 0.5) as int) end spd,
             cast(vid % 5 as int) xway, cast(step % 5 as int) lane,
             case when stops and step = 13 and event_id % 3 = 0 then 1 - dir0 else dir0 end dir,
             case when dir0 = 0 then 273280 + v * 30 * moved
                  else 300960 - v * 30 * moved end pos
      from p),
ints as (select seq, time, vid, spd, xway, lane, dir, cast(floor(pos / 5280.0) as int) seg, pos
         from q)"""

SENSOR = """
sensor as (select cast(floor(epoch(ts)) as bigint) ts, event_type id, value, event_id seq
           from events)"""


def _reports_sql(preset: str) -> str:
    if preset != "compact":
        return f"{REPORTS},\nreports as (select * from ints)"
    narrow = ", ".join(f"cast({c} as tinyint) as {c}" for c in COMPACT)
    return f"{REPORTS},\nreports as (select * replace ({narrow}) from ints)"


def _speed_fines_sql(preset: str) -> str:
    column = "dir" if preset == "radar" else "pos"
    return f"select time, vid, xway, seg, {column}, spd from reports where spd > 90"


def _average_speed_ctes(preset: str) -> str:
    gap = 60000 if preset in ("section60", "compact") else 30000
    section = "seg between 52 and 56"
    if preset == "compact":
        section += " and (seg in (52, 56) or xway not in (0, 4))"
    arrival = "partition by vid order by time, seq"
    return f"""
marked as (select *, case when time - lag(time) over ({arrival}) <= {gap} then 0 else 1 end first
           from reports where {section}),
numbered as (select *, sum(first) over ({arrival} rows unbounded preceding) session from marked),
ends as (select vid,
           arg_min({{'time': time, 'pos': pos, 'xway': xway, 'dir': dir}}, (pos, -time, -seq))
             filter (seg = 52) entry,
           arg_max({{'time': time, 'pos': pos, 'dir': dir}}, (pos, time, seq))
             filter (seg = 56) leave
         from numbered group by vid, session),
deltas as (select *, abs(leave.pos - entry.pos) dp, nullif(abs(leave.time - entry.time), 0) dt
           from ends where entry.dir = leave.dir),
speeds as (select *, 2.2369::double * (dp // dt) whole, 2.2369::double * dp / dt exact
           from deltas)"""


def _average_speed_sql(preset: str) -> str:
    mph = {
        "section60": "cast(floor(whole + 0.5) as int)",
        "telematics": "cast(floor(whole + 0.5) as int)",
        "opt": "cast(floor(whole + 0.5) as int)",
        "compact": "round(exact, 6)",
    }[preset]
    test = {
        "section60": "floor(whole + 0.5) > 60",
        "telematics": "floor(whole + 0.5) > 60",
        "opt": "whole > 60",
        "compact": "exact > 60",
    }[preset]
    return f"""select entry.time time1, leave.time time2, vid, entry.xway xway, entry.dir dir,
  {mph} avgspd from speeds where {test}"""


def _accident_ctes(preset: str) -> str:
    where = "" if preset == "telematics" else "where spd = 0"
    return f"""
framed as (select *, lag(time, 3) over w time_3, lag(xway, 3) over w xway_3,
             lag(seg, 3) over w seg_3, lag(dir, 3) over w dir_3,
             count(*) over f n, min(pos) over f low, max(pos) over f high,
             min(dir) over f dir_low, max(dir) over f dir_high
           from reports {where}
           window w as (partition by vid order by time, seq),
                  f as (partition by vid order by time, seq rows 3 preceding))"""


def _accident_sql(preset: str) -> str:
    same_dir = "and dir_low = dir_high" if preset == "compact" else ""
    return f"""select time_3 time1, time time2, vid, xway_3 xway, seg_3 seg, dir_3 dir, pos
  from framed where n = 4 and low = high {same_dir}"""


def _job_sql(preset: str) -> str:
    fines = "radar" if preset == "telematics" else preset
    dir_, pos = ("dir", "null") if fines == "radar" else ("null", "pos")
    return f"""with {_reports_sql(preset)}, {_average_speed_ctes(preset)}, {_accident_ctes(preset)}
select 'speed' kind, time time1, cast(null as int) time2, vid, cast(xway as int) xway,
       cast(seg as int) seg, cast({dir_} as int) dir, cast({pos} as int) pos,
       cast(spd as double) speed
from ({_speed_fines_sql(fines)})
union all
select 'average', time1, time2, vid, cast(xway as int), null, cast(dir as int), null,
       cast(avgspd as double)
from ({_average_speed_sql(preset)})
union all
select 'accident', time1, time2, vid, cast(xway as int), cast(seg as int), cast(dir as int), pos,
       null
from ({_accident_sql(preset)})"""


def _rolling_sql(kind: str) -> str:
    ts = "ts" if kind == "reduce" else "first_value(ts) over w"
    function = "sum" if kind == "reduce" else kind
    return f"""with {SENSOR}
select {ts} ts, id, round({function}(value) over w, 6) as value, seq from sensor
window w as (partition by id order by ts, seq rows unbounded preceding)"""


def _sliding_sql(size: int, slide: int) -> str:
    return f"""with {SENSOR}
select ts - ts % {slide} - o window_start, max(ts) ts, id, round(sum(value), 6) as value
from sensor cross join (select range o from range(0, {size}, {slide})) offsets
group by id, ts - ts % {slide} - o"""


def _tokens_sql() -> str:
    return r"""
pieces as (select doc_id seq, string_split_regex(lower(text), '\W+') list from documents),
tokens as (select * from (select seq, unnest(list) word,
                                 cast(generate_subscripts(list, 1) - 1 as int) pos from pieces)
           where word <> '')"""


def oracle_sql() -> dict[str, str]:
    """Name -> the same result in DuckDB's SQL."""
    out: dict[str, str] = {}
    for preset in ("radar", "opt", "compact"):
        out[f"speed_fines_{preset}"] = f"with {_reports_sql(preset)}\n{_speed_fines_sql(preset)}"
    for preset in ("section60", "telematics", "opt", "compact"):
        ctes = f"{_reports_sql(preset)}, {_average_speed_ctes(preset)}"
        out[f"avg_speed_{preset}"] = f"with {ctes}\n{_average_speed_sql(preset)}"
    for preset in ("telematics", "opt", "compact"):
        ctes = f"{_reports_sql(preset)}, {_accident_ctes(preset)}"
        out[f"accidents_{preset}"] = f"with {ctes}\n{_accident_sql(preset)}"
    out["telematics_job"] = _job_sql("telematics")
    out["telematics_job_opt"] = _job_sql("opt")
    out["telematics_job_compact"] = _job_sql("compact")
    out["telematics_findings"] = out["telematics_job"]
    out["sensor_filter"] = f"with {SENSOR}\nselect ts, id, value, seq from sensor where value > 20"
    out["sensor_fanout"] = f"""with {SENSOR}
select ts, id, value, seq from sensor where id = 'click'
union all select ts, id, 1.0::double, seq from sensor where id = 'click'
union all select ts, 'this is a string test', 134.0::double, seq from sensor where id = 'click'"""
    for kind in ("min", "max", "sum"):
        out[f"rolling_{kind}"] = _rolling_sql(kind)
    out["keyed_reduce"] = _rolling_sql("reduce")
    out["sliding_sum"] = _sliding_sql(3, 1)
    out["sliding_sum_wide"] = _sliding_sql(3600, 600)
    out["sliding_sum_long"] = _sliding_sql(3600, 60)
    out["word_count"] = f"""with {_tokens_sql()}
select word, count(*) as count from tokens group by word"""
    out["running_word_count"] = f"""with {_tokens_sql()}
select seq, pos, word,
       row_number() over (partition by word order by seq, pos) as count from tokens"""
    columns = ", ".join(REPORT_COLUMNS)
    out["report_parse"] = f"with {_reports_sql('')}\nselect {columns} from reports"
    out["report_parse_compact"] = f"with {_reports_sql('compact')}\nselect {columns} from reports"
    out["report_parse_lenient"] = out["report_parse"]
    out["line_roundtrip"] = f"""with {_reports_sql('')}
select concat_ws(',', {columns}) as value from reports"""
    out["csv_roundtrip"] = f"with {SENSOR}\nselect ts, id, value from sensor"
    out["tuple_text"] = f"""with {_reports_sql('')}
select concat('(', concat_ws(',', time, vid, xway, seg, dir, spd), ')') as value
from ({_speed_fines_sql('radar')})"""
    out["accidents_split"] = out["accidents_telematics"]
    out["avg_speed_split"] = out["avg_speed_telematics"]
    out["rolling_sum_split"] = out["rolling_sum"]
    out["running_word_count_split"] = out["running_word_count"]
    out["keyed_reduce_files"] = f"select ts, id, value from ({out['keyed_reduce']})"
    out["stream_running_word_count"] = out["running_word_count"]
    out["stream_accidents"] = out["accidents_telematics"]
    out["stream_avg_speed"] = out["avg_speed_telematics"]
    out["stream_sliding_sum"] = out["sliding_sum"]
    out["stream_sliding_sum_wide"] = out["sliding_sum_wide"]
    out["stream_rolling_sum"] = out["rolling_sum"]
    out["stream_word_count"] = out["word_count"]
    out["stream_accidents_by_batch"] = out["accidents_telematics"]
    out["stream_rolling_sum_by_batch"] = out["rolling_sum"]
    out["stream_telematics_job"] = out["telematics_job"]
    out["stream_keyed_reduce_files"] = out["keyed_reduce_files"]
    if training_data:
        out |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
