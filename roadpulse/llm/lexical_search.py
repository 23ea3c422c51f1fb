"""Ranked lexical search for many items at once, sharing what the items have in common.

Scores are sums over an item's terms, so items that share terms share partial sums. Per block of
items, term sets that several items hold are mined (first terms that occur in exactly the same
items, then pairs of such sets, most shared first); they form a graph in which every node is the
sum of two others or of terms. A task works each node out once per batch of documents, as a row
of partial scores, and the items are sums over few nodes. Two passes read the documents: one
counts each document's terms and stages those that any item asks for, from which the corpus
statistics come; one scores the staged counts and keeps the best per item and task, so that only
a task's best meet in the final ranking.

A block holds at most BLOCK_ITEMS items and begins anew where its items' terms pass BLOCK_TERMS;
what a task gets as a broadcast is bounded by that. Blocks are searched one after the other.

Terms are the runs of letters and digits of ASCII and of any other characters outside ASCII, with
A-Z lower-cased. Arithmetic is that of 64-bit integers; only a weight's logarithm is a double.

Defined cases. A null or empty text has no terms; such an item finds nothing, such a document is
never found and not counted. Equal scores go by ascending ``doc_id``, null last; repeated rows are
found once each. Repeated rows of an item (same ``item_id`` and text) are one item; one ``item_id``
with several texts gets one list for each. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import arrow_batches, cut_bytes, running_total, staged, whole_text

TOP = 10
BLOCK_ITEMS = 512
BLOCK_TERMS = 16_384
# Only cost depends on these: rows held by most items that pairs are mined among, pairs merged.
MINED_ROWS = 2_048
MERGED_PAIRS = 1_024
BATCH_ROWS = 512
SEGMENT = 1 << 22
LAST_ID = 2**63 - 1

# What a byte of a text counts as: ASCII letters and digits as themselves (lower case), other
# ASCII as a space, bytes of characters beyond ASCII as themselves.
_FOLD = bytes(
    (ord(chr(i).lower()) if chr(i).isalnum() else 32) if i < 128 else i for i in range(256)
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a long one in several lists."""
    for piece in cut_bytes(text.translate(_FOLD), SEGMENT):
        yield piece.split()


# --- items


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        item, term, count = [], [], []
        for number, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
            bag: dict[bytes, int] = {}
            for found in terms(text):
                for t in found:
                    bag[t] = bag.get(t, 0) + 1
            item += [number] * len(bag)
            term += bag.keys()
            count += bag.values()
        arrays = [pa.array(item, pa.int64()), pa.array(term, pa.binary()), pa.array(count, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "term", "count"])


def numbered_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, item_id, block) and (item, block, term, count); ``item`` numbers the distinct rows."""
    distinct = items.select("item_id", whole_text(F.col("text")).cast("binary").alias("text")).distinct()
    rows = running_total(distinct, ["item_id", "text"], F.lit(1), "item")
    bags = staged(rows.select("item", "text").mapInArrow(_item_terms, "item long, term binary, count long"), "bags")
    sizes = bags.groupBy("item").agg(F.count("*").alias("n_terms"))
    sized = rows.select("item", "item_id").join(sizes, "item", "left").fillna(0, "n_terms")
    before = running_total(sized, ["item"], F.col("n_terms"), "terms_before")
    block = F.struct(
        F.floor(F.col("terms_before") / BLOCK_TERMS).alias("by_terms"),
        F.floor(F.col("item") / BLOCK_ITEMS).alias("by_items"),
    )
    blocked = staged(before.select("item", "item_id", block.alias("block")), "items")
    return blocked, bags.join(blocked.select("item", "block"), "item")


@dataclass
class Graph:
    """``sums`` adds rows: rows 0 to n_terms - 1 belong to terms, each later row is the sum of
    those it lists, and ``items`` says which rows, and how often, make up an item."""

    sums: list[np.ndarray]
    items: list[np.ndarray]


def sharing_graph(n_terms: int, bags: list[dict[int, int]], most: int = MERGED_PAIRS) -> Graph:
    """Mine what the items (term -> count) share."""
    holders: dict[int, list[tuple[int, int]]] = {}
    for i, bag in enumerate(bags):
        for t, k in bag.items():
            holders.setdefault(t, []).append((i, k))
    # Terms of exactly the same items, as often in each: one set, summed once.
    alike: dict[tuple, list[int]] = {}
    for t, held in holders.items():
        alike.setdefault(tuple(held), []).append(t)
    sums: list[np.ndarray] = []
    members: list[dict[int, int]] = [{} for _ in bags]
    for held, ts in alike.items():
        if len(ts) > 1 and len(held) > 1:
            sums.append(np.array(ts))
            row = n_terms + len(sums) - 1
            for i, k in held:
                members[i][row] = k
        else:
            for t in ts:
                for i, k in held:
                    members[i][t] = k
    # Pairs that two or more items hold equally often: the most shared pair becomes a node.
    held_by = Counter(r for m in members for r in m)
    shared = [r for r, n in held_by.most_common(MINED_ROWS) if n > 1]
    at = {r: j for j, r in enumerate(shared)}
    width = len(shared)
    if width > 1:
        holds = np.zeros((len(bags), width + min(most, width)), np.float32)
        for i, m in enumerate(members):
            for r, k in m.items():
                if k == 1 and r in at:
                    holds[i, at[r]] = 1
        rows = list(shared)
        both = holds.T @ holds
        np.fill_diagonal(both, 0)
        while len(rows) < holds.shape[1]:
            x, y = divmod(int(both.argmax()), both.shape[1])
            if both[x, y] < 2:
                break
            new, j = holds[:, x] * holds[:, y], len(rows)
            sums.append(np.array([rows[x], rows[y]]))
            rows.append(n_terms + len(sums) - 1)
            for i in np.flatnonzero(new):
                del members[i][rows[x]], members[i][rows[y]]
                members[i][rows[j]] = 1
            holds[:, x] -= new
            holds[:, y] -= new
            holds[:, j] = new
            for c in (x, y, j):
                both[c] = both[:, c] = holds[:, c] @ holds
                both[c, c] = 0
    return Graph(sums, [np.repeat(np.array(list(m), int), list(m.values())) for m in members])


# --- documents


def _counter(vocabulary: list[bytes]) -> Callable:
    """(doc_id, n, codes, counts) per document with terms, codes and counts of asked terms only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {t: i for i, t in enumerate(vocabulary)}
        for batch in batches:
            docs, ns, codes, counts = [], [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                n, found = 0, []
                for some in terms(text):
                    n += len(some)
                    found += [code[t] for t in some if t in code]
                if n:
                    own, times = np.unique(np.array(found, np.int32), return_counts=True)
                    docs.append(doc_id)
                    ns.append(n)
                    codes.append(own.astype("<i4").tobytes())
                    counts.append(times.astype("<i4").tobytes())
            arrays = [
                pa.array(docs, pa.int64()), pa.array(ns, pa.int64()),
                pa.array(codes, pa.binary()), pa.array(counts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n", "codes", "counts"])

    return run


def _flat(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4")


def _holders(n_terms: int) -> Callable:
    """(code, df) of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch["codes"]), minlength=n_terms)
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(total[code])], names=["code", "df"])

    return run


class _Best:
    """The best documents of each item so far."""

    def __init__(self, n_items: int):
        shape = (n_items, TOP)
        self.score = np.zeros(shape, np.int64)
        self.null = np.ones(shape, bool)
        self.doc = np.full(shape, LAST_ID)

    def add(self, scores: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document."""
        bar = np.maximum(self.score[:, -1:], 1)
        item, at = np.nonzero(scores >= bar)
        for i in np.unique(item):
            mine = at[item == i]
            score = np.concatenate([self.score[i], scores[i, mine]])
            is_null = np.concatenate([self.null[i], null[mine]])
            ids = np.concatenate([self.doc[i], doc[mine]])
            first = np.lexsort((ids, is_null, -score))[:TOP]
            self.score[i], self.null[i], self.doc[i] = score[first], is_null[first], ids[first]


def _scorer(weights: np.ndarray, n_docs_terms: tuple[int, int], graph: Graph) -> Callable:
    """(item, doc_id, score) of a task's best documents per item of the block."""
    n_docs, n_all = n_docs_terms
    n_terms = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(graph.items))
        for batch in batches:
            n, width = batch["n"].to_numpy(), len(batch)
            m = 100 - 75 + (75 * n * n_docs) // n_all
            codes, counts = _flat(batch["codes"]), _flat(batch["counts"]).astype(np.int64)
            sizes = np.fromiter((len(b) // 4 for b in batch["codes"].to_pylist()), np.int64, width)
            doc = np.repeat(np.arange(width), sizes)
            parts = np.zeros((n_terms + len(graph.sums), width), np.int64)
            parts[codes, doc] = weights[codes] * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[doc]))
            for row, summed in enumerate(graph.sums, n_terms):
                parts[summed].sum(axis=0, out=parts[row])
            scores = np.zeros((len(graph.items), width), np.int64)
            for i, rows in enumerate(graph.items):
                if len(rows):
                    parts[rows].sum(axis=0, out=scores[i])
            null = np.asarray(batch["doc_id"].is_null())
            best.add(scores, null, np.asarray(batch["doc_id"].fill_null(LAST_ID)))
        item, at = np.nonzero(best.score)
        ids = pa.array(best.doc[item, at], mask=best.null[item, at])
        arrays = [pa.array(item.astype(np.int64)), ids, pa.array(best.score[item, at])]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "score"])

    return run


def search(items: DataFrame, docs: DataFrame) -> DataFrame:
    """(item, item_id, rank, doc_id, score): the best TOP documents of each item."""
    spark = docs.sparkSession
    numbered, bags = numbered_items(items)
    blocks = [r[0] for r in numbered.select("block").distinct().orderBy("block").collect()]
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).cast("binary").alias("text")
    )
    found = []
    for block in blocks:
        here = F.col("block") == F.struct(F.lit(block[0]).alias("by_terms"), F.lit(block[1]).alias("by_items"))
        rows = bags.where(here).select("item", "term", "count").collect()  # bounded, see above
        vocabulary = sorted({bytes(r.term) for r in rows})
        code = {t: i for i, t in enumerate(vocabulary)}
        wanted: dict[int, dict[int, int]] = {}
        for r in rows:
            wanted.setdefault(r.item, {})[code[bytes(r.term)]] = r["count"]
        if not wanted:
            continue
        numbers = sorted(wanted)
        with arrow_batches(spark, BATCH_ROWS):
            counted = staged(
                texts.mapInArrow(_counter(vocabulary), "doc_id long, n long, codes binary, counts binary"),
                "terms",
            )
            n_docs, n_all = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
            if not n_docs:
                continue
            held = np.zeros(len(vocabulary), np.int64)
            holders = counted.select("codes").mapInArrow(_holders(len(vocabulary)), "code long, df long")
            for c, df in holders.groupBy("code").agg(F.sum("df")).collect():  # a row per asked term
                held[c] = df
            weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()])
            graph = sharing_graph(len(vocabulary), [wanted[i] for i in numbers])
            best = staged(
                counted.mapInArrow(_scorer(weights, (n_docs, n_all), graph), "row long, doc_id long, score long"),
                "best",
            )
        item = F.element_at(F.lit(numbers).cast("array<long>"), (F.col("row") + 1).cast("int"))
        found.append(best.select(item.alias("item"), "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item long, item_id long, rank int, doc_id long, score long")
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = all_found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return top.join(numbered.select("item", "item_id"), "item").select("item", "item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(items, docs).drop("item")


SQL = r"""
with t as (select doc_id, row_number() over () as row_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
i as (select item_id, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
      from (select distinct item_id, text from benchmark)),
q as (select item_id, term, count(*) as times from i group by all),
d as (select row_id, doc_id, count(*)::bigint as n from t group by all),
s as (select count(*)::bigint as big_n, sum(n)::bigint as big_l from d),
f as (select row_id, term, count(*)::bigint as tf from t
      where term in (select term from q) group by all),
w as (select term, cast(floor(1000 * ln((2 * big_n + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
      from f, s group by term, big_n),
c as (select f.row_id, f.term, doc_id,
             w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l))) as part
      from f join d using (row_id) join w using (term), s),
r as (select item_id, row_id, doc_id, sum(times * part)::bigint as score
      from q join c using (term) group by all having score > 0),
n as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as place from r)
select item_id, place::int as rank, doc_id, score from n where place <= 10"""
