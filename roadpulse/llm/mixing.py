"""Mixing of sources to target weights by Pareto order sampling.

Each source gets a target in words. Its share of copies per document is target over
source size; the whole part of that is given to every document, the rest is sampled:
documents are ranked by their random odds u / (1 - u) over the inclusion odds
f / (1 - f) of their source (f being the fraction left), and taken in that order until
the words left to give are used up. Random odds come from a digest of seed and
``doc_id``, so reruns, retries and other partitionings agree.

Native: DataFrame functions only. Word counts are staged once; targets need only sums
by source, and the driver sees three numbers per round of resharing. No source is ever
sorted whole: ranks fall into buckets that are summed before the shuffle, and only the
bucket in which the words run out, some BUCKET_ROWS distinct rows with their counts, is put in
order. The rows at which they run out, alike but perhaps many, are numbered within tasks.

Defined cases. A null text has size 0, and what has size 0 is taken 0 times. A null
source is a source, the last one. Repeated rows share one rank and come one after the other;
rows of one ``doc_id`` but different size are ordered by size. Where the words run out among rows
equal in id and size, as many of them are taken as fit. A null ``doc_id`` is drawn like the empty id. If all sizes are 0, so are all targets. Other columns are carried
along untouched by ``mixed`` and not read by ``copies``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import staged, whole_text, words

BUCKET_ROWS = 4096
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"


def _size() -> Column:
    return F.size(words(whole_text(F.col("text")))).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with ``place``, their number by code point from 0, null last.

    Ranges of sources are numbered apart and shifted by the counts of earlier ranges, so
    that no task sees all sources.
    """
    order = F.col("source").asc_nulls_last()
    spark = sources.sparkSession
    ranges = max(2, spark.sparkContext.defaultParallelism)
    parts = staged(
        sources.repartitionByRange(ranges, order).withColumn("part", F.spark_partition_id()),
        "sources",
    )
    counts = parts.groupBy("part").agg(F.count("*").alias("n_before"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    shifts = counts.select("part", F.coalesce(F.sum("n_before").over(earlier), F.lit(0)).alias("shift"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("within", within).join(shifts, "part").select(
        "source", "source_size", "n_docs", (F.col("within") + F.col("shift")).alias("place")
    )


def _level(sources: DataFrame, most: int) -> float:
    """Words per unit of weight once every source above its limit is cut and the rest reshared."""
    limit = most * F.col("source_size")
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, cut = (total or 0) / (weight or 1), -1
    while True:
        over = limit <= F.lit(level) * F.col("weight")
        given, free, now = sources.agg(
            F.coalesce(F.sum(F.when(over, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.count(F.when(over, 1)),
        ).first()
        if now == cut or not free:
            return level
        level, cut = (total - given) / free, now


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: its size, target, whole copies, and what sampling needs."""
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    choice = F.array(*(F.lit(w) for w in weights))
    weighted = staged(
        _ranked(sums).withColumn(
            "weight", F.get(choice, (F.col("place") % len(weights)).cast("int"))
        ),
        "weights",
    )
    level = _level(weighted, most)
    target = F.least(
        (most * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight")
    )
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor("share"), F.lit(most)).cast("long")
    return (
        weighted.withColumn("target", target)
        .withColumn("share", share)
        .withColumn("whole", whole)
        .select(
            "source", "source_size", "target", "whole",
            (F.col("share") - F.col("whole")).alias("fraction"),
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
            F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long").alias("n_buckets"),
        )
    )


def _rank(seed: str) -> Column:
    """Random odds over inclusion odds; null for what sampling cannot take."""
    digits = F.substring(
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13
    )
    u = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16**13))
    odds = F.col("fraction") / (1 - F.col("fraction"))
    return F.when((F.col("fraction") > 0) & (F.col("size") > 0), u / (1 - u) / odds)


def _bucket() -> Column:
    rank = F.col("rank")
    return F.floor(rank / (1 + rank) * F.col("n_buckets")).cast("long")


def _drawn(sized: DataFrame, per_source: DataFrame, seed: str) -> DataFrame:
    return (
        sized.join(per_source, sized["source"].eqNullSafe(per_source["p_source"]))
        .withColumn("rank", _rank(seed))
        .withColumn("bucket", _bucket())
    )


def plan(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED):
    """(doc_id, source, size) of all documents, and per source what decides on its documents.

    A document is taken ``whole`` times, and once more if its bucket lies before ``edge``, or if it
    lies in ``edge`` and before ``last``, or is one of the first ``last.fit`` rows equal to ``last``.
    """
    sized = staged(docs.select("doc_id", "source", _size().alias("size")), "sizes")
    per_source = staged(
        targets(sized, weights, most).withColumnRenamed("source", "p_source"), "targets"
    )
    drawn = _drawn(sized, per_source, seed).where(F.col("rank").isNotNull())
    sums = drawn.groupBy("p_source", "bucket").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    )
    earlier = (
        Window.partitionBy("p_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    edges = (
        running.where(F.col("before") <= F.col("rest"))
        .groupBy("p_source")
        .agg(F.max(F.struct("bucket", "before")).alias("e"))
        .select(F.col("p_source").alias("e_source"), "e.bucket", "e.before")
        .select("e_source", F.col("bucket").alias("edge"), F.col("before").alias("edge_before"))
    )
    at_edge = drawn.join(
        edges,
        F.col("p_source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("edge")),
    )
    alike = at_edge.groupBy("p_source", "rank", "doc_id", "size").agg(
        F.count("*").alias("n"), F.first("rest").alias("rest"), F.first("edge_before").alias("edge_before")
    )
    in_order = (
        Window.partitionBy("p_source")
        .orderBy("rank", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("edge_before") + F.coalesce(F.sum(F.col("n") * F.col("size")).over(in_order), F.lit(0))
    # A row is taken if half of it fits: before + (rows like it) * size + size / 2 <= rest.
    room = F.floor((F.col("rest") - F.col("before") - F.col("size") / 2) / F.col("size")) + 1
    lasts = (
        alike.withColumn("before", before)
        .withColumn("fit", F.least("n", room))
        .where("fit > 0")
        .groupBy(F.col("p_source").alias("l_source"))
        .agg(F.max(F.struct("rank", "doc_id", "size", "fit", "n")).alias("last"))
    )
    joined = per_source.join(edges, F.col("p_source").eqNullSafe(F.col("e_source")), "left").join(
        lasts, F.col("p_source").eqNullSafe(F.col("l_source")), "left"
    )
    return sized, staged(joined.drop("e_source", "l_source"), "mix")


def _taken(sized: DataFrame, rules: DataFrame, seed: str) -> DataFrame:
    """``sized`` with the number of copies of each row that are taken."""
    drawn = _drawn(sized, rules, seed)
    last = F.struct("last.rank", "last.doc_id", "last.size")
    at_edge = F.coalesce(F.col("bucket") == F.col("edge"), F.lit(False))
    equal = at_edge & F.coalesce(F.struct("rank", "doc_id", "size").eqNullSafe(last), F.lit(False))
    split = equal & (F.col("last.fit") < F.col("last.n"))
    extra = (F.col("bucket") < F.col("edge")) | (at_edge & (F.struct("rank", "doc_id", "size") <= last))
    decided = drawn.where(~split).withColumn(
        "copies", _times(F.col("rank").isNotNull() & F.coalesce(extra, F.lit(False)))
    )
    if rules.where(F.col("last.fit") < F.col("last.n")).isEmpty():
        return decided
    # Rows alike, of which some are taken: numbered as they lie in the staged table.
    some = staged(drawn.where(split).withColumn("task", F.spark_partition_id()), "edge")
    counts = some.groupBy("p_source", "task").agg(F.count("*").alias("n"))
    tasks_before = Window.partitionBy("p_source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("p_source").alias("t_source"), F.col("task").alias("t_task"),
        F.coalesce(F.sum("n").over(tasks_before), F.lit(0)).alias("shift"),
    )
    own = Window.partitionBy("p_source", "task").orderBy(F.xxhash64(*[c for c in sized.columns]))
    numbered = some.withColumn("at", F.row_number().over(own)).join(
        shifts, F.col("p_source").eqNullSafe(F.col("t_source")) & (F.col("task") == F.col("t_task"))
    )
    fits = F.col("at") + F.col("shift") <= F.col("last.fit")
    return decided.unionByName(numbered.withColumn("copies", _times(fits)).drop("at", "shift", "t_source", "t_task", "task"))


def _times(extra: Column) -> Column:
    return F.when(F.col("size") > 0, F.col("whole") + F.when(extra, 1).otherwise(0)).otherwise(0)


def copies(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """Per document: size, its source's size and target, how often and with how many words taken."""
    sized, rules = plan(docs, weights, most, seed)
    return _taken(sized, rules, seed).select(
        "doc_id", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns it came with."""
    _, rules = plan(docs, weights, most, seed)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", _size().alias("size"))
    taken = _taken(rows, rules, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    return copies(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")


SQL = f"""
with recursive d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from s),
lv as (
  select 0 as step, (select sum(source_size) / sum(weight) from w) as level, -1::bigint as cut
  union all
  select step + 1, coalesce((select (sum(source_size) - coalesce(sum({MOST} * source_size) filter (over), 0))
                             / sum(weight) filter (not over)
                    from (select *, {MOST} * source_size <= level * weight as over from w)), level),
         (select count(*) from w where {MOST} * source_size <= level * weight)
  from lv
  where cut <> (select count(*) from w where {MOST} * source_size <= level * weight)),
p as (select *, least(({MOST} * source_size)::double,
                      (select level from lv order by step desc limit 1) * weight) as target from w),
q as (select *, case when source_size > 0 then target / source_size else 0 end as share from p),
r as (select *, least(floor(share), {MOST})::bigint as whole from q),
f as (select *, share - whole as fraction, target - whole * source_size as rest from r),
u as (select doc_id, size, f.source, source_size, target, whole, fraction, rest,
             (('0x' || md5('{SEED}:' || coalesce(doc_id::varchar, ''))[1:13])::bigint + 0.5::double)
               / {16**13}::double as u
      from d join f on d.source is not distinct from f.source),
k as (select *, case when fraction > 0 and size > 0
                     then u / (1 - u) / (fraction / (1 - fraction)) end as place from u),
b as (select *, coalesce(sum(size) over (partition by source, place is null order by place, doc_id, size
                   rows between unbounded preceding and 1 preceding), 0) as before from k)
select doc_id, size, source_size, target,
       case when size = 0 then 0 else size * (whole + case when place is not null
              and before + size / 2.0::double <= rest then 1 else 0 end) end::bigint as taken
from b"""
