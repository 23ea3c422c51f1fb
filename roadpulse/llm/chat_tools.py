"""Chat formatting: tool calls linked to their results, ordered, validated, as canonical JSON.

Messages are (conv_id, turn, role, text). An assistant message may hold calls,
``{"tool_calls": [{"id", "name", "arguments", "after": [ids of earlier calls]}]}``, a tool
message a result, ``{"tool_call_id", "content"}``; any other text holds none.

Calls and results are hash-joined by conversation and identifier. A call's level is 0 if
it waits for no known call, else one more than the highest level that it waits for;
levels are found in rounds, one per level. Calls on a cycle or behind one have no level
and come last. Positions within a conversation are counted over sorted ranges, so a
conversation may lie in many of them and no task holds one whole.

Native: DataFrame functions only, JSON through ``from_json`` and ``variant``.

Defined cases. Without conversation or call id a call is linked with nothing ('no_id').
Of several results for one call the one with the smallest turn, then text, counts, and
``n_results`` tells. Calls that repeat an id stay, each linked ('duplicate'). Results
without a call are rows of their own ('orphan'). Names in ``after`` without a call are
left out of the order and listed as errors. Invalid or null arguments are 'invalid_json'
or 'missing'. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import staged

# The tools of the test conversations: field -> (type, required).
TOOLS = {
    "configure": {"prompt": ("string", True), "turn": ("integer", True)},
    "search": {"query": ("string", True), "turn": ("integer", True), "limit": ("integer", False)},
}
# How each type of a schema shows in a variant's own type name.
TYPES = {
    "string": "^STRING$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "boolean": "^BOOLEAN$",
    "number": r"^(BIGINT|DOUBLE|DECIMAL\(.*\))$", "object": "^OBJECT<.*>$", "array": "^ARRAY<.*>$",
}

_CALLS = "tool_calls array<struct<id string, name string, arguments string, after array<string>>>"


def calls_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, name, arguments, after, row_id) of all calls, staged."""
    parsed = messages.where("role = 'assistant'").select(
        "conv_id", "turn", F.explode(F.from_json("text", _CALLS)["tool_calls"]).alias("c")
    )
    after = F.array_distinct(F.coalesce("c.after", F.array().cast("array<string>")))
    return staged(
        parsed.where("c is not null").select(
            "conv_id", "turn", F.col("c.id").alias("call_id"), "c.name", "c.arguments",
            F.filter(after, lambda x: x.isNotNull()).alias("after"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "calls",
    )


def results_of(messages: DataFrame) -> DataFrame:
    """(r_conv, r_id, r_turn, content, n_results): the first result for each identifier."""
    parsed = messages.where("role = 'tool'").select(
        "conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("r")
    )
    grouped = parsed.where("r.tool_call_id is not null").groupBy(
        F.col("conv_id").alias("r_conv"), F.col("r.tool_call_id").alias("r_id")
    )
    first = F.min(F.struct("turn", "r.content"))
    return grouped.agg(first.alias("f"), F.count("*").alias("n_results")).select(
        "r_conv", "r_id", F.col("f.turn").alias("r_turn"), F.col("f.content").alias("content"), "n_results"
    )


def levels(calls: DataFrame) -> DataFrame:
    """(row_id, level, unknown): level null on and behind cycles; ``unknown`` names no call."""
    ids = calls.where("conv_id is not null and call_id is not null").select(
        F.col("conv_id").alias("k_conv"), F.col("call_id").alias("k_id"), F.col("row_id").alias("waits_for")
    )
    waits = calls.select("conv_id", "row_id", F.explode("after").alias("name"))
    edges = staged(
        waits.join(ids, (F.col("conv_id") == F.col("k_conv")) & (F.col("name") == F.col("k_id")), "left")
        .select("row_id", "name", "waits_for"),
        "edges",
    )
    unknown = edges.where("waits_for is null").groupBy("row_id").agg(
        F.sort_array(F.collect_set("name")).alias("unknown")
    )
    known = edges.where("waits_for is not null").select("row_id", "waits_for")
    needs = known.groupBy("row_id").agg(F.count("*").alias("needs"))
    start = calls.select("row_id").join(needs, "row_id", "left_anti").withColumn("level", F.lit(0))
    done, front, level = staged(start, "levels"), start, 0
    while True:
        # Only calls that wait for one of the last level can have come free.
        touched = known.join(front.select(F.col("row_id").alias("waits_for")), "waits_for").select("row_id")
        met = known.join(touched.distinct(), "row_id", "left_semi").join(
            done.select(F.col("row_id").alias("waits_for")), "waits_for", "left_semi"
        )
        level += 1
        free = met.groupBy("row_id").agg(F.count("*").alias("met")).join(needs, "row_id").where("met = needs")
        fresh = free.select("row_id").join(done, "row_id", "left_anti").withColumn("level", F.lit(level))
        front = staged(fresh, "levels")
        if front.isEmpty():
            break
        done = done.union(front)
    return calls.select("row_id").join(done, "row_id", "left").join(unknown, "row_id", "left")


def errors(tools: dict[str, dict[str, tuple[str, bool]]] = TOOLS) -> Column:
    """What is wrong with ``arguments`` by the schema of the tool ``name``, sorted."""
    value = F.try_parse_json("arguments")
    checks = [
        F.when(F.col("arguments").isNull(), F.array(F.lit("missing")))
        .when(value.isNull(), F.array(F.lit("invalid_json")))
        .when(~F.schema_of_variant(value).startswith("OBJECT<"), F.array(F.lit("no_object")))
    ]
    checks.append(
        F.when(F.coalesce(F.col("name").isin(*tools), F.lit(False)), F.lit(None)).otherwise(
            F.array(F.lit("unknown_tool"))
        )
    )
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    for tool, fields in tools.items():
        wrong = []
        for field, (kind, required) in fields.items():
            found = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            bad = F.when(~found.rlike(TYPES[kind]), F.lit(f"not_{kind}:{field}"))
            if required:
                bad = F.when(found.isNull(), F.lit(f"required:{field}")).otherwise(bad)
            wrong.append(bad)
        own = F.filter(F.array(*wrong), lambda e: e.isNotNull())
        keys = F.array_except(F.json_object_keys("arguments"), F.array(*map(F.lit, fields)))
        extra = F.transform(keys, lambda k: F.concat(F.lit("unknown_field:"), k))
        checks.append(F.when((F.col("name") == tool) & is_object, F.concat(own, extra)))
    empty = F.array().cast("array<string>")
    return F.sort_array(F.concat(*(F.coalesce(c, empty) for c in checks)))


def _positions(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` with ``place``, counted from 0 within ``conv_id`` in the given order."""
    spark = rows.sparkSession
    ranges = max(2, spark.sparkContext.defaultParallelism)
    parts = staged(
        rows.repartitionByRange(ranges, F.col("conv_id"), *order).withColumn("part", F.spark_partition_id()),
        "ordered",
    )
    counts = parts.groupBy("conv_id", "part").agg(F.count("*").alias("n_part"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        F.col("conv_id").alias("s_conv"), F.col("part").alias("s_part"),
        F.coalesce(F.sum("n_part").over(earlier), F.lit(0)).alias("shift"),
    )
    within = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)) - 1
    same = F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("part") == F.col("s_part"))
    return (
        parts.withColumn("within", within).join(shifts, same)
        .withColumn("place", F.col("within") + F.col("shift")).drop("part", "within", "shift", "s_conv", "s_part")
    )


def linked(messages: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """A row per call, and per result without a call, in order of (conv_id, place).

    ``json`` is canonical: keys sorted at every depth, no spaces, null fields left out.
    """
    calls, results = calls_of(messages), results_of(messages)
    ordered = calls.join(levels(calls), "row_id")
    ids = ordered.groupBy("conv_id", "call_id").agg(F.count("*").alias("n_calls"))
    both = ordered.join(
        ids.toDF("i_conv", "i_id", "n_calls"),
        F.col("conv_id").eqNullSafe(F.col("i_conv")) & F.col("call_id").eqNullSafe(F.col("i_id")),
    ).join(results, (F.col("conv_id") == F.col("r_conv")) & (F.col("call_id") == F.col("r_id")), "left")
    status = (
        F.when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "no_id")
        .when(F.col("n_calls") > 1, "duplicate")
        .when(F.col("r_id").isNull(), "unanswered")
        .otherwise("linked")
    )
    empty = F.array().cast("array<string>")
    unmet = F.transform(F.coalesce("unknown", empty), lambda n: F.concat(F.lit("unknown_call:"), n))
    kept = both.select(
        "conv_id", "call_id", "turn", "r_turn", "name", "level", status.alias("status"),
        F.concat(errors(tools), unmet).alias("errors"), "arguments", "after", "content",
        F.coalesce("n_results", F.lit(0)).alias("n_results"), "row_id",
    )
    ids_of_calls = calls.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_id"))
    orphans = results.join(ids_of_calls, ["r_conv", "r_id"], "left_anti").select(
        F.col("r_conv").alias("conv_id"), F.col("r_id").alias("call_id"), "r_turn", "content", "n_results",
        F.lit("orphan").alias("status"), empty.alias("errors"),
    )
    rows = kept.unionByName(orphans, allowMissingColumns=True)
    value = F.try_parse_json("arguments")
    json = F.to_json(
        F.struct(
            F.when(F.size("after") > 0, F.sort_array("after")).alias("after"), value.alias("arguments"),
            F.col("call_id").alias("id"), "name", F.col("content").alias("result"),
        )
    )
    order = [
        F.col("level").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("call_id"), F.col("row_id"),
    ]
    return _positions(rows.withColumn("json", json), order).select(
        "conv_id", "call_id", "turn", "r_turn", "name", "level", "place", "status", "errors", "n_results",
        "json",
    )


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """The test conversations told as tool use: what a user or system turn asks is a call of the
    assistant that waits for the calls of turns // 2 and // 3; the next turn is the result."""
    turn = F.col("turn")
    call_id = lambda t: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    system = F.col("role") == "system"
    arguments = F.struct(
        F.when(system, F.col("text")).alias("prompt"), F.when(~system, F.col("text")).alias("query"), "turn"
    )
    halves = F.array(F.floor(turn / 2), F.floor(turn / 3))
    after = F.transform(F.filter(halves, lambda t: t < turn), call_id)
    calls = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    call_id(turn).alias("id"), F.when(system, "configure").otherwise("search").alias("name"),
                    arguments.alias("arguments"), after.alias("after"),
                )
            ).alias("tool_calls")
        )
    )
    result = F.to_json(F.struct(call_id(turn - 1).alias("tool_call_id"), F.col("text").alias("content")))
    answer = F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn", F.when(answer, "tool").otherwise("assistant").alias("role"),
        F.when(answer, result).otherwise(calls).alias("text"),
    )


def op8_chat_tools(spark, sf_dir: str) -> DataFrame:
    rows = linked(as_tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    return rows.withColumn("errors", F.array_join("errors", ";"))


SQL = """
with recursive c as (
  select conv_id, turn, role, text, 'c' || conv_id || '-' || turn as call_id from conversations
  where role <> 'assistant'),
r as (select conv_id, 'c' || conv_id || '-' || (turn - 1) as call_id, min(turn) as r_turn,
             arg_min(text, {'a': turn, 'b': text}) as content, count(*) as n_results
      from conversations where role = 'assistant' group by all),
w as (select distinct conv_id, turn, t from (
        select conv_id, turn, unnest([turn // 2, turn // 3]) as t from c) where t < turn),
e as (select w.conv_id, w.turn, w.t from w join c on c.conv_id = w.conv_id and c.turn = w.t),
paths as (
  select conv_id, turn, 0 as level from c
  union
  select e.conv_id, e.turn, level + 1 from paths join e on e.conv_id = paths.conv_id and e.t = paths.turn),
lv as (select conv_id, turn, max(level) as level from paths group by all),
un as (select w.conv_id, w.turn, string_agg('unknown_call:c' || w.conv_id || '-' || w.t, ';'
              order by 'c' || w.conv_id || '-' || w.t) as errors
       from w left join c on c.conv_id = w.conv_id and c.turn = w.t where c.turn is null group by all),
af as (select conv_id, turn, string_agg('"c' || conv_id || '-' || t || '"', ','
              order by 'c' || conv_id || '-' || t) as after from w group by all),
al as (
  select c.conv_id, c.call_id, c.turn, r_turn, case when role = 'system' then 'configure' else 'search' end as name,
         level, case when r.call_id is null then 'unanswered' else 'linked' end as status,
         coalesce(errors, '') as errors, coalesce(n_results, 0) as n_results,
         '{' || coalesce('"after":[' || after || '],', '') || '"arguments":{'
           || case when role = 'system' then '"prompt":' else '"query":' end || to_json(text)::varchar
           || ',"turn":' || c.turn || '},"id":"' || c.call_id || '","name":"'
           || case when role = 'system' then 'configure' else 'search' end || '"'
           || coalesce(',"result":' || to_json(content)::varchar, '') || '}' as json
  from c join lv using (conv_id, turn) left join r on r.conv_id = c.conv_id and r.call_id = c.call_id
  left join un on un.conv_id = c.conv_id and un.turn = c.turn
  left join af on af.conv_id = c.conv_id and af.turn = c.turn
  union all
  select conv_id, call_id, null, r_turn, null, null, 'orphan', '', n_results,
         '{"id":"' || call_id || '","result":' || to_json(content)::varchar || '}'
  from r where not exists (select 1 from c where c.conv_id = r.conv_id and c.call_id = r.call_id))
select *, row_number() over (partition by conv_id order by level nulls last, turn nulls last, call_id) - 1 as place
from al"""
