"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores what was measured and
one bit per failed rule; a policy is a versioned set of rules, so a new version or
an ablation reads the ledger and never the texts.

Native: all of it is column expressions and runs without a shuffle; only the ablation
groups, by failure mask, of which there are at most 2 ** len(RULES).

Defined cases. A null or empty text has no words, measures 0 everywhere and fails
``few_words``. Repeated rows are judged each on its own, a null ``doc_id`` is passed on.
Other columns of the input are not read, whatever their names. A window of eight words
is compared by a 64-bit hash, within one text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import let, strip, whole_text, words

WINDOW = 8
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)

# A rule's place in this table is its bit. It fails where the condition holds.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "short_words": "2 * word_chars < 5 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "10 * n_dup_lines > 4 * n_lines",
}
BASE = ("few_words", "repeated_windows")
POLICIES = {"base": BASE, "v1": tuple(RULES)}


def mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a policy, given by version or as rule names."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << list(RULES).index(name) for name in names)


def _covered(hashes: Column) -> Column:
    """How many words lie in windows whose hash occurs twice or more.

    Sorted by hash, equal windows are neighbours; their starts in order then give the
    words that each covers before the next one begins.
    """

    def starts(ordered: Column) -> Column:
        def repeated(window: Column, at: Column) -> Column:
            before, after = F.get(ordered, at - 1), F.get(ordered, at + 1)
            same = (window["h"] == before["h"]) | (window["h"] == after["h"])
            return F.when(same, window["i"])

        return F.sort_array(F.filter(F.transform(ordered, repeated), lambda i: i.isNotNull()))

    def total(begin: Column) -> Column:
        gaps = F.transform(
            begin, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(begin, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, gap: a + gap)

    numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(let(F.sort_array(numbered), starts), total)


def measured(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` and the measurements of each document."""
    text = whole_text(F.col("text"))
    split = docs.select(
        *keep,
        text.alias("_text"),
        words(F.col("text")).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda line: strip(line) != "").alias("_lines"),
    )
    kept = [c for c in split.columns if c not in ("_text", "_words", "_lines")]
    count = F.size("_words")

    def hashes(all_words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(all_words) - (WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(all_words, i, F.lit(WINDOW))))

    windows = split.withColumn(
        "_windows",
        F.when(count >= WINDOW, let(F.col("_words"), hashes)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    long = {
        "n_words": count,
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.char_length("_text")
        - F.char_length(F.regexp_replace("_text", r"[#*$%&|<>]", "")),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(repeats, _covered(F.col("_windows"))).otherwise(F.lit(0)),
    }
    # A generator, so that a condition on a measurement is not moved below it and worked out anew.
    values = F.array(F.struct(*(long[m].cast("long").alias(m) for m in MEASURES)))
    return windows.select(*kept, F.inline(values))


def ledger(docs: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns ``keep``, the measurements and ``failures``, one bit per rule."""
    bits = [
        F.when(F.expr(fails), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")
        for bit, fails in enumerate(RULES.values())
    ]
    failures = bits[0]
    for bit in bits[1:]:
        failures = failures.bitwiseOR(bit)
    names = dict.fromkeys(("doc_id", *keep))
    return measured(docs, *(F.col(c) for c in names)).withColumn("failures", failures)


def passes(policy: str | tuple[str, ...]) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(book: DataFrame, policy: str | tuple[str, ...]) -> DataFrame:
    """Per rule of the policy: documents failing it, and failing it alone (kept without it)."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    within = F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long"))
    by_mask = book.groupBy(within.alias("failures")).agg(F.count("*").alias("n"))
    rules = F.explode(
        F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(mask((n,))).alias("bit")) for n in names))
    )
    each = by_mask.select("failures", "n", rules.alias("r")).select("failures", "n", "r.*")
    fails = F.col("failures").bitwiseAND(F.col("bit").cast("long")) != 0
    return each.groupBy("rule").agg(
        F.sum(F.when(fails, F.col("n")).otherwise(F.lit(0))).alias("n_failed"),
        F.sum(F.when(F.col("failures") == F.col("bit"), F.col("n")).otherwise(F.lit(0))).alias(
            "n_only"
        ),
    )


def rejected_go(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that pass the policy, with the columns they came with."""
    row = docs.select(F.struct("*").alias("row"), "text")
    book = measured(row, F.col("row"))
    fails = [F.expr(RULES[name]) for name in POLICIES[policy]]
    bad = fails[0]
    for other in fails[1:]:
        bad = bad | other
    return book.where(~bad).select("row.*")


def op6_quality_rules(spark, sf_dir: str) -> DataFrame:
    book = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes("base")).alias("base_failed"), passes("v1").alias("kept"), "failures",
    )


_WORD = r"[^\x20\x09-\x0D]+"

SQL = rf"""
with t as (select row_number() over () as row_id, doc_id, coalesce(text, '') as body from documents),
w as (select row_id, doc_id, body, regexp_extract_all(body, '{_WORD}') as ws,
             list_filter(string_split(body, chr(10)), lambda l: regexp_matches(l, '{_WORD}')) as ls
      from t),
starts as (select row_id, i, count(*) over (partition by row_id, win) as seen
           from (select row_id, i, ws[i:i + {WINDOW - 1}] as win
                 from (select row_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) as i from w))),
rep as (select row_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) as n
        from (select row_id, i, lead(i) over (partition by row_id order by i) as following
              from starts where seen > 1)
        group by row_id),
m as (select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
             length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines,
             cast(coalesce(n, 0) as bigint) as n_repeat_words
      from w left join rep using (row_id)),
f as (select *, {" + ".join(f"case when {c} then {1 << b} else 0 end" for b, c in enumerate(RULES.values()))} as bits
      from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & {mask("base")} <> 0 as base_failed, bits & {mask("v1")} = 0 as kept,
       cast(bits as bigint) as failures
from f"""
