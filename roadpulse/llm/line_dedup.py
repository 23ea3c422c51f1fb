"""Removal of lines that an earlier document holds.

A line's key is the line without separators at both ends and with A-Z lower-cased. Two
64-bit hashes stand for it. The distinct hashes are counted with partial sums before the
shuffle and dealt to shards; each shard gets a minimal perfect hash whose numbers index
arrays of 32-bit fingerprints, 8-bit counts and first documents. Documents send their
line hashes to the shards and probe the arrays; no line is joined with another.

A shard's rows follow its arrays in one sorted stream, so a task holds one shard's arrays
and one batch of probes, however many documents hold a line. Keys with over 1 / HEADS of
all lines (so at most HEADS of them, which is why they may be broadcast) have arrays of
their own, of which every shard gets a copy, and their probes go to all shards in turn.

Defined cases. A null or empty text is one empty line. Keys under MIN_CHARS code points
are never dropped. A null ``doc_id`` counts as one document that comes after all others.
Rows with the same ``doc_id`` are one document as a holder of lines, and each loses its
own lines. Other columns are carried along untouched, but for ``n_chars``, which follows
the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import ascii_lower, staged, strip, whole_text
from roadpulse.llm.minimal_hash import ABSENT, MinimalHash

MIN_CHARS = 10
SHARD_LINES = 200_000
LEAST_SHARDS = 64
HEADS = 4096
LAST_ID = 2**63 - 1
SALT = 1_000_003

_ARRAYS = "sizes binary, bits binary, marks binary, counts binary, firsts binary"


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def _tag() -> Column:
    """Tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64("text")


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc, tag, at, a, b): the hashes of every line with a key that is long enough."""
    lines = docs.select(
        _doc().alias("doc"),
        _tag().alias("tag"),
        F.posexplode(F.split(whole_text(F.col("text")), "\n", -1)).alias("at", "line"),
    )
    keys = lines.select("doc", "tag", "at", ascii_lower(strip(F.col("line"))).alias("key"))
    return keys.where(F.char_length("key") >= MIN_CHARS).select(
        "doc", "tag", "at", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(SALT), "key").alias("b")
    )


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, np.int64).view(np.uint64)


def _build(keys: pa.Table) -> pa.Table:
    """The arrays of one shard's distinct keys."""
    a, b = _unsigned(keys["a"].to_numpy()), _unsigned(keys["b"].to_numpy())
    numbers = MinimalHash.build(a, b)
    at = numbers.find(a, b)
    marks, counts = np.empty(len(a), np.uint32), np.empty(len(a), np.uint8)
    firsts = np.empty(len(a), np.int64)
    marks[at] = (b >> np.uint64(32)).astype(np.uint32)
    counts[at] = np.minimum(keys["n_docs"].to_numpy(), 255)
    firsts[at] = keys["first_doc"].to_numpy()
    arrays = (numbers.sizes, numbers.bits, marks, counts, firsts)
    columns = [keys["shard"].slice(0, 1), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)]
    return pa.table(columns, ["shard", *(c.split()[0] for c in _ARRAYS.split(", "))])


class _Shard:
    def __init__(self, sizes, bits, marks, counts, firsts):
        self.numbers = MinimalHash(np.frombuffer(bits, np.uint64), np.frombuffer(sizes, np.int64))
        self.marks = np.frombuffer(marks, np.uint32)
        self.counts = np.frombuffer(counts, np.uint8)
        self.firsts = np.frombuffer(firsts, np.int64)

    def repeats(self, a, b, doc) -> np.ndarray:
        """Whether each line is one that an earlier document holds."""
        out = np.zeros(len(a), bool)
        at = self.numbers.find(a, b)
        known = np.flatnonzero(at != ABSENT)
        known = known[self.marks[at[known]] == (b[known] >> np.uint64(32)).astype(np.uint32)]
        out[known] = (self.counts[at[known]] >= 2) & (self.firsts[at[known]] != doc[known])
        return out


_HIT = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("at", pa.int32())])


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: up to two rows with arrays (the shard's, the heads'), then probes."""
    arrays: dict[bool, _Shard] = {}
    current = None
    for batch in batches:
        shard, kind = batch["shard"].to_numpy(), batch["kind"].to_numpy()
        ends = np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1
        for low, high in zip([0, *ends], [*ends, len(shard)]):
            if low == high:
                continue
            if shard[low] != current:
                current, arrays = shard[low], {}
            part = batch.slice(low, high - low)
            if kind[low] < 2:
                one = (part[name][0].as_py() for name in ("sizes", "bits", "marks", "counts", "firsts"))
                arrays[kind[low] == 1] = _Shard(*one)
                continue
            index = arrays.get(kind[low] == 3)
            if index is None:
                continue
            doc = part["doc"].to_numpy()
            hit = index.repeats(_unsigned(part["a"]), _unsigned(part["b"]), doc)
            if hit.any():
                columns = [pa.array(part[n].to_numpy()[hit]) for n in ("doc", "tag", "at")]
                yield pa.RecordBatch.from_arrays(columns, schema=_HIT)


def _index(counted: DataFrame, shards: int, heads: DataFrame) -> DataFrame:
    """(shard, kind, arrays): kind 0 is the shard's own index, 1 its copy of the heads'."""
    keyed = counted.withColumn("shard", F.pmod("a", F.lit(shards)).cast("int"))
    schema = f"shard int, {_ARRAYS}"
    own = keyed.groupBy("shard").applyInArrow(_build, schema).withColumn("kind", F.lit(0))
    few = heads.withColumn("shard", F.lit(-1)).groupBy("shard").applyInArrow(_build, schema)
    spread = few.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return own.unionByName(spread.withColumn("kind", F.lit(1)))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc, tag, drops): per document that loses lines, their places from 0."""
    counted = staged(
        line_hashes(docs)
        .groupBy("a", "b")
        .agg(
            F.count("*").alias("n_lines"),
            F.min("doc").alias("first_doc"),
            F.max("doc").alias("last_doc"),
        )
        .withColumn(
            "n_docs",  # 1, or at least 2
            F.when(F.col("first_doc") == F.col("last_doc"), 1).otherwise(F.least("n_lines", F.lit(255))),
        ),
        "lines",
    )
    total = counted.agg(F.sum("n_lines")).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-total // SHARD_LINES))
    heads = counted.where(F.col("n_lines") * HEADS > total)
    probes = line_hashes(docs).join(
        F.broadcast(heads.select("a", "b", F.lit(True).alias("head"))), ["a", "b"], "left"
    )
    empty = [F.lit(None).cast("binary").alias(c.split()[0]) for c in _ARRAYS.split(", ")]
    salted = F.pmod(F.xxhash64("doc", "tag", "at"), F.lit(shards))
    asked = probes.select(
        F.when(F.col("head"), salted).otherwise(F.pmod("a", F.lit(shards))).cast("int").alias("shard"),
        F.when(F.col("head"), 3).otherwise(2).alias("kind"), "doc", "tag", "at", "a", "b", *empty,
    )
    stream = _index(counted, shards, heads).unionByName(asked, allowMissingColumns=True)
    hits = (
        stream.repartition("shard")
        .sortWithinPartitions("shard", "kind")
        .mapInArrow(_probe, "doc long, tag long, at int")
    )
    return hits.groupBy("doc", "tag").agg(F.collect_set("at").alias("drops"))


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    def kept(text: str, gone: list | None) -> str:
        if gone is None:
            return text
        gone = set(gone)
        return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)

    return pa.array((kept(t.as_py(), g.as_py()) for t, g in zip(texts, drops)), pa.string())


def _deduped(docs: DataFrame) -> DataFrame:
    """(row, doc, text, kept, drops): ``text`` whole, ``kept`` without repeated lines."""
    rows = docs.select(
        F.struct("*").alias("row"), _doc().alias("doc"), _tag().alias("tag"),
        whole_text(F.col("text")).alias("text"),
    )
    gone = repeated_lines(docs).hint("shuffle_hash")
    return rows.join(gone, ["doc", "tag"], "left").withColumn(
        "kept", _without(F.col("text"), F.col("drops"))
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The documents with the lines that they keep, and the columns they came with."""
    row = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.char_length("kept").cast(docs.schema["n_chars"].dataType))
    return _deduped(docs).select(row.alias("row")).select("row.*")


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    done = _deduped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


SQL = r"""
with t as (select row_number() over () as row_id, doc_id,
                  coalesce(doc_id, 9223372036854775807) as doc, coalesce(text, '') as body
           from documents),
l as (select row_id, doc, generate_subscripts(ls, 1) as i, unnest(ls) as line
      from (select row_id, doc, string_split(body, chr(10)) as ls from t)),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
h as (select key, min(doc) as first_doc, count(distinct doc) as n from k
      where length(key) >= 10 group by key),
j as (select k.*, coalesce(h.n >= 2 and h.first_doc <> k.doc, false) as gone
      from k left join h on k.key = h.key and length(k.key) >= 10),
g as (select row_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
             coalesce(string_agg(line, chr(10) order by i) filter (not gone), '') as kept
      from j group by row_id)
select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256 from t join g using (row_id)"""
