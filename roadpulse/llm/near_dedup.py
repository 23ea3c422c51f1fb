"""Near-duplicate documents by banded MinHash, checked with odd sketches and then exactly.

A document's set holds its distinct shingles, runs of ``width`` words (WIDTH, word pairs,
unless asked otherwise; A-Z lower-cased; a text with fewer words stands for itself). Equal sets are one class; only classes go on. A class has BANDS keys of ROWS
MinHash values each, and an odd sketch: the parities, by bit position, of its SAMPLE
smallest hash values. Sets up to SAMPLE are sampled whole, and then the bits in which two
sketches differ are at most the elements in which the sets differ, so a pair rejected by
its sketches is certainly below the threshold. Larger sets leave six deviations of room.

Which pairs are looked at. In a bucket of up to SMALL classes, all. In a larger one, each
member with PIVOTS members; then, if the bucket still holds several components, each
member outside its largest component with all members, in blocks of QUERIES. No pair
within a component is looked at, and in a bucket no list of all pairs is ever made.

Links are confirmed on the full sets of words. First each class's likeliest partner is
confirmed; of the other pairs only those between different components are left. In a large
bucket a member outside is confirmed with the likeliest members of a component first; while
that leaves the two apart, more of them follow until no pair is held back.

Two texts at similarity 0.8 share no band with probability (1 - 0.8 ** ROWS) ** BANDS,
5e-6, and less above.

Defined cases. Null, empty and blank texts have an empty set and are linked with nothing.
Rows of one ``doc_id`` are judged each on its own text. A null ``doc_id`` is above all
others; a class of such rows only has a null ``component_id``. Of several rows with the
smallest ``doc_id`` of a component all are kept. Other columns are carried along
untouched by ``one_of_each`` and not read otherwise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import arrow_batches, ascii_lower, staged, whole_text, words
from roadpulse.llm.components import components

WIDTH = 2
ROWS, BANDS = 6, 40
SAMPLE = 16_384
SMALL = 24
MEMBERS = 512  # members of a large bucket that meet its pivots together
PIVOTS = 3
QUERIES = 256
FIRST, MORE = 1, 32
LAST_ID = 2**63 - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 over the golden ratio
_STEP = 128
_PART = 500
BATCH_ROWS = 1000

_random = np.random.default_rng(20240501)
_FACTORS = _random.integers(0, 2**32, ROWS * BANDS, np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, ROWS * BANDS, np.uint64).astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


def shingle_set(word_hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words."""
    w = word_hashes.view(np.uint64)
    length = max(1, min(width, len(w)))
    runs = len(w) - length + 1
    h = w[:runs]
    for i in range(1, length):
        h = _mix(h) * np.uint64(3) + w[i : i + runs]
    return np.unique(_mix(h if len(w) >= width else h + np.uint64(1)))


def minhashes(items: np.ndarray) -> np.ndarray:
    """The smallest value of every hash function over the set."""
    x = (items >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_FACTORS), 2**32 - 1, np.uint32)
    room = np.empty((_STEP, len(_FACTORS)), np.uint32)
    for low in range(0, len(x), _STEP):
        part = x[low : low + _STEP]
        values = room[: len(part)]
        np.multiply(part[:, None], _FACTORS, out=values)
        np.add(values, _SHIFTS, out=values)
        np.minimum(least, values.min(0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD
    for column in least.reshape(BANDS, ROWS).T:
        key = _mix(key ^ column.astype(np.uint64))
    return key.view(np.int64)


def odd_sketch(items: np.ndarray) -> bytes:
    """Parity bitmap of the smallest SAMPLE values, of two to four bits a value."""
    sample = items[:SAMPLE]
    size = 256
    while size < 2 * len(sample):
        size *= 2
    at = (_mix(sample ^ _ODD) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=size) & 1, bitorder="little").tobytes()


def folded(sketches: np.ndarray, width: int) -> np.ndarray:
    """Sketches (a row each, in 64-bit words) as they are with fewer bits."""
    return np.bitwise_xor.reduce(sketches.reshape(len(sketches), -1, width), axis=1)


def limit(n_a, n_b):
    """The most differing bits at which sets of these sizes may reach the threshold."""
    whole = (n_a + n_b) / 9  # similarity 0.8: one ninth of both sizes differs
    sampled = 0.4 * SAMPLE + 6 * np.sqrt(0.4 * SAMPLE)
    return np.where(np.maximum(n_a, n_b) > SAMPLE, sampled, whole)


_FEATURES = pa.schema(
    [("row_id", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("n", pa.int64()),
     ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())]
)


def _features(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    parts = (b.slice(low, _PART) for b in batches for low in range(0, b.num_rows, _PART))
    for batch in parts:
        lists = batch["words"]
        flat = lists.flatten().to_numpy()
        ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
        out = []
        for low, high in zip([0, *ends[:-1]], ends):
            items = shingle_set(flat[low:high], width)
            if not len(items):
                out.append((0, 0, 0, None, None))
                continue
            digest = np.frombuffer(hashlib.blake2b(items.tobytes(), digest_size=16).digest(), np.int64)
            out.append((len(items), *digest.tolist(), band_keys(minhashes(items)), odd_sketch(items)))
        columns = list(zip(*out)) if out else [()] * 5
        own = [pa.array(c, f.type) for c, f in zip(columns, list(_FEATURES)[3:])]
        keep = [batch[name] for name in ("row_id", "doc", "tag")]
        yield pa.RecordBatch.from_arrays(keep + own, schema=_FEATURES)


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def _tag() -> Column:
    return F.xxhash64("text")


def features(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(row_id, doc, tag, n, d1, d2, bands, sketch) per row; ``tag`` tells texts of a doc apart."""
    hashes = F.transform(words(ascii_lower(whole_text(F.col("text")))), lambda w: F.xxhash64(w))
    return docs.select(
        F.monotonically_increasing_id().alias("row_id"), _doc().alias("doc"), _tag().alias("tag"),
        hashes.alias("words"),
    ).mapInArrow(
        lambda batches: _features(batches, width),
        "row_id long, doc long, tag long, n long, d1 long, d2 long, bands array<long>, sketch binary",
    )


def _sizes_allow(a: str = "n_a", b: str = "n_b") -> Column:
    return 100 * F.least(a, b) >= 80 * F.greatest(a, b)


def _in_small(members: DataFrame) -> DataFrame:
    """All pairs of the buckets that have at most SMALL members."""
    lists = members.where(F.col("size") <= SMALL).groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("cls", "n"))).alias("m")
    )
    lower = F.transform("m", lambda x, i: F.struct(x.alias("x"), F.slice("m", i + 2, SMALL).alias("above")))
    return (
        lists.select(F.explode(lower).alias("p"))
        .select("p.x", F.explode("p.above").alias("y"))
        .select("x.cls", "x.n", F.col("y.cls").alias("b"), F.col("y.n").alias("n_b"))
        .toDF("a", "n_a", "b", "n_b")
    )


def _with_pivots(members: DataFrame) -> DataFrame:
    """Pairs of each member of a large bucket with PIVOTS members of it."""
    large = members.where(F.col("size") > SMALL)
    pivots = large.groupBy("key").agg(
        *(F.min_by(F.struct("cls", "n"), F.xxhash64("cls", F.lit(i))).alias(f"p{i}") for i in range(PIVOTS))
    )
    # A bucket's size is known: its members are dealt to as many parts as it holds MEMBERS of them,
    # each of which gets the pivots.
    parts = F.ceil(F.col("size") / MEMBERS)
    dealt = large.select("key", "cls", "n", F.pmod(F.xxhash64("cls"), parts).alias("part"))
    sizes = large.groupBy("key").agg(F.first(parts).alias("parts"))
    each = pivots.join(sizes, "key").select(
        "key", F.explode(F.array(*(f"p{i}" for i in range(PIVOTS)))).alias("p"), "parts"
    )
    each = each.select("key", "p.*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = dealt.join(each.toDF("key", "p_cls", "p_n", "part"), ["key", "part"])
    low = F.col("cls") < F.col("p_cls")
    return pairs.where("cls <> p_cls").select(
        F.least("cls", "p_cls").alias("a"), F.when(low, F.col("n")).otherwise(F.col("p_n")).alias("n_a"),
        F.greatest("cls", "p_cls").alias("b"), F.when(low, F.col("p_n")).otherwise(F.col("n")).alias("n_b"),
    )


def _count_differing(left: pa.Array, right: pa.Array) -> pa.Array:
    """Bits in which two sketches differ, the longer one folded."""

    def count(a: bytes, b: bytes) -> int:
        x, y = np.frombuffer(a, np.uint64)[None], np.frombuffer(b, np.uint64)[None]
        width = min(x.shape[1], y.shape[1])
        return int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum())

    return pa.array([count(a.as_py(), b.as_py()) for a, b in zip(left, right)], pa.int64())


# A filter on what a function in Python returns moves below the column that holds it, and the function then
# runs in two Python steps, each with a worker of its own per core. It stays above what is not known to be
# deterministic, so sketches are compared once.
_differing = F.arrow_udf(_count_differing, T.LongType()).asNondeterministic()


def _limit() -> Column:
    """``limit`` as a column."""
    sampled = F.greatest("n_a", "n_b") > SAMPLE
    return F.when(sampled, float(limit(SAMPLE + 1, SAMPLE))).otherwise((F.col("n_a") + F.col("n_b")) / 9)


def _passing(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The distinct pairs (a, b, bits, limit) that their sketches do not reject."""
    distinct = pairs.where(_sizes_allow()).groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
    left = reps.select(F.col("cls").alias("a"), F.col("sketch").alias("s_a"))
    right = reps.select(F.col("cls").alias("b"), F.col("sketch").alias("s_b"))
    both = distinct.join(left, "a").join(right, "b")
    measured = both.select("a", "b", _differing("s_a", "s_b").alias("bits"), _limit().alias("limit"))
    return measured.where("bits <= limit")


def _linked(left: Column, right: Column, width: int) -> Column:
    """Whether the full sets reach the threshold. Bytes split and lower as the definition asks."""

    def items(text: str) -> set:
        w = text.encode().lower().split()
        return set(zip(*(w[i:] for i in range(width)))) if len(w) >= width else {tuple(w)} - {()}

    def linked(a: str, b: str) -> bool:
        x, y = items(a), items(b)
        both = len(x & y)
        return 100 * both >= 80 * (len(x) + len(y) - both)

    @F.arrow_udf(T.BooleanType())
    def each(left: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([linked(a.as_py(), b.as_py()) for a, b in zip(left, right)], pa.bool_())

    return each(left, right)


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) whose texts are linked."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("t_a"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("t_b"))
    # Sorted joins: one class may stand in very many pairs, and such a partition can be split.
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.where(_linked(F.col("t_a"), F.col("t_b"), width)).select("a", "b")


def _across(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    left, right = comps.toDF("a", "c_a"), comps.toDF("b", "c_b")
    both = pairs.join(left, "a", "left").join(right, "b", "left")
    return both.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).drop("c_a", "c_b")


def _likeliest(pairs: DataFrame) -> DataFrame:
    """Per class the pair with the fewest differing bits for its limit."""
    share = F.col("bits") / F.col("limit")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cls"), F.struct(share.alias("s"), "a", "b").alias("p"))
    return ends.groupBy("cls").agg(F.min("p").alias("p")).select("p.a", "p.b").distinct()


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("held", pa.bool_())])


class _Block:
    """Up to some QUERIES classes of a bucket, held against a stream of its members."""

    def __init__(self, most_sure: int):
        self.most_sure = most_sure
        self.rows: list[tuple] = []

    def add(self, part: pa.RecordBatch) -> None:
        columns = (part[c].to_pylist() for c in ("cls", "component", "n", "sketch"))
        self.rows += [(c, m, n, np.frombuffer(s, np.uint64)) for c, m, n, s in zip(*columns)]

    def pairs(self, part: pa.RecordBatch) -> Iterator[tuple]:
        """Pairs not rejected, between components; of the likely ones ``most_sure`` per component.

        The third value tells that likely pairs with the same component are held back.
        """
        cls, component, n = (part[c].to_numpy() for c in ("cls", "component", "n"))
        sketches = part["sketch"].to_pylist()
        by_width: dict[int, list[int]] = {}
        for i, s in enumerate(sketches):
            by_width.setdefault(len(s) // 8, []).append(i)
        for width, at in by_width.items():
            at = np.array(at)
            block = np.frombuffer(b"".join([sketches[i] for i in at]), np.uint64).reshape(len(at), width)
            for own, own_component, own_n, sketch in self.rows:
                near = min(width, len(sketch))
                if not 2 * min(width, len(sketch)) >= max(width, len(sketch)):
                    continue  # sizes too far apart
                bits = np.bitwise_count(folded(block, near) ^ folded(sketch[None], near)).sum(1)
                most = limit(n[at], own_n)
                ok = (bits <= most) & (component[at] != own_component)
                ok &= 100 * np.minimum(n[at], own_n) >= 80 * np.maximum(n[at], own_n)
                met: dict[int, list[int]] = {}
                for i in np.flatnonzero(ok)[np.argsort(bits[ok] / most[ok], kind="stable")]:
                    other = int(cls[at[i]])
                    if bits[i] <= 0.75 * most[i]:
                        met.setdefault(component[at[i]], []).append(other)
                    else:
                        yield min(own, other), max(own, other), False
                for likely in met.values():
                    held = len(likely) > self.most_sure
                    for other in likely[: self.most_sure]:
                        yield min(own, other), max(own, other), held


def _blocks(batches: Iterator[pa.RecordBatch], most_sure: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block, kind): a block's queries (kind 0), then members (kind 1)."""
    current, block = None, _Block(most_sure)
    for batch in batches:
        group = np.stack([batch[c].to_numpy() for c in ("key", "block", "kind")])
        ends = np.flatnonzero(np.any(np.diff(group, axis=1) != 0, axis=0)) + 1
        found: list[tuple] = []
        for low, high in zip([0, *ends], [*ends, batch.num_rows]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            if (head := tuple(group[:2, low])) != current:
                current, block = head, _Block(most_sure)
            if group[2, low] == 0:
                block.add(part)
            else:
                found += block.pairs(part)
        if found:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*found), _PAIR)]
            yield pa.RecordBatch.from_arrays(columns, schema=_PAIR)


def _left_over(members: DataFrame, comps: DataFrame, reps: DataFrame, most_sure: int) -> DataFrame:
    """Pairs (a, b, held) of large buckets that several components share, outside the largest one."""
    large = members.where(F.col("size") > SMALL).select("key", "cls", "n")
    placed = large.join(comps.toDF("cls", "component"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    buckets = (
        counts.groupBy("key")
        .agg(F.max(F.struct("c", "component")).alias("top"), F.sum("c").alias("all"))
        .where(F.col("all") > F.col("top.c"))
        .select(
            "key", F.col("top.component").alias("largest"),
            F.ceil((F.col("all") - F.col("top.c")) / QUERIES).cast("long").alias("blocks"),
        )
    )
    open_ = placed.join(buckets, "key").join(reps.select("cls", "sketch"), "cls")
    columns = ("key", "block", "kind", "cls", "component", "n", "sketch")
    queries = open_.where("component <> largest").withColumns(
        {"block": F.pmod(F.xxhash64("cls"), "blocks"), "kind": F.lit(0)}
    )
    against = open_.withColumns(
        {"block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)), "kind": F.lit(1)}
    )
    rows = queries.select(*columns).union(against.select(*columns))
    found = (
        rows.repartition("key", "block")
        .sortWithinPartitions("key", "block", "kind")
        .mapInArrow(lambda batches: _blocks(batches, most_sure), "a long, b long, held boolean")
    )
    return found.groupBy("a", "b").agg(F.max("held").alias("held"))


def _with_left_over(
    members: DataFrame, comps: DataFrame, reps: DataFrame, texts: DataFrame, width: int
) -> DataFrame:
    """The components when all pairs of large buckets are confirmed or within one.

    A pair that was held back is within a component once the pair handed on for it is. The
    number of pairs handed on grows by a factor, so few rounds reach the whole of a batch.
    """
    most_sure, tried = FIRST, None
    while True:
        found = staged(_left_over(members, comps, reps, most_sure), "left")
        fresh = found if tried is None else found.join(tried, ["a", "b"], "left_anti")
        late = _confirmed(fresh, texts, width)
        comps = staged(components(comps.toDF("a", "b").union(late)), "components")
        if _across(found.where("held"), comps).isEmpty():
            return comps
        tried = found.select("a", "b") if tried is None else tried.union(fresh.select("a", "b"))
        most_sure *= MORE


def classes_and_components(docs: DataFrame, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(row_id, doc, tag, n, d1, d2) of all rows, and (d1, d2, component_id) of all classes."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _classes_and_components(docs, width)


def _classes_and_components(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    rows = staged(features(docs, width), "features")
    full = rows.where("n > 0")
    classes = staged(
        full.groupBy("d1", "d2").agg(F.min("row_id").alias("cls"), F.min("doc").alias("first_doc")),
        "classes",
    )
    reps = full.join(classes.select(F.col("cls").alias("row_id")), "row_id", "left_semi").withColumnRenamed(
        "row_id", "cls"
    )
    keys = reps.select("cls", "n", F.explode("bands").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = staged(keys.join(sizes, "key"), "members")
    candidates = _in_small(members).union(_with_pivots(members))
    passing = staged(_passing(candidates, reps), "pairs")

    open_classes = passing.select(F.explode(F.array("a", "b")).alias("cls")).union(
        members.where(F.col("size") > SMALL).select("cls")
    )
    wanted = reps.select("cls", "doc", "tag").join(open_classes.distinct(), "cls", "left_semi")
    source = docs.select(_doc().alias("doc"), _tag().alias("tag"), whole_text(F.col("text")).alias("text"))
    texts = staged(
        source.join(wanted.hint("shuffle_hash"), ["doc", "tag"]).select("cls", "text"), "texts"
    )

    first = _likeliest(passing)
    links = staged(_confirmed(first, texts, width), "links")
    comps = staged(components(links), "components")
    rest = _across(passing.join(first, ["a", "b"], "left_anti"), comps)
    links = staged(links.union(_confirmed(rest, texts, width)), "links")
    comps = staged(components(links), "components")
    comps = _with_left_over(members, comps, reps, texts, width)

    of_class = classes.join(comps.toDF("cls", "component"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    ids = of_class.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    named = of_class.join(ids, "component").select("d1", "d2", "component_id")
    return rows.select("row_id", "doc", "tag", "n", "d1", "d2"), named


def memberships(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per row: doc, tag, n_shingles and the id of its component."""
    rows, named = classes_and_components(docs, width)
    with_words = F.col("n") > 0
    joined = rows.withColumn("has", with_words).join(named, ["d1", "d2"], "left")
    own = F.when(F.col("has"), F.col("component_id")).otherwise(F.col("doc"))
    return joined.select("doc", "tag", F.col("n").alias("n_shingles"), own.alias("component"))


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One document of each component, the one with the smallest id, with its columns.

    Rows that repeat its id and text are copies of it: one of them stays.
    """
    judged = staged(
        memberships(docs, width).where(F.col("doc") == F.col("component"))
        .groupBy("doc", "tag").agg(F.count("*").alias("n_rows")), "stay",
    )
    rows = docs.select(F.struct("*").alias("row"), _doc().alias("doc"), _tag().alias("tag"))
    stays = lambda which: rows.join(
        judged.where(which).select("doc", "tag").hint("shuffle_hash"), ["doc", "tag"], "left_semi"
    )
    once = stays("n_rows = 1")
    if judged.where("n_rows > 1").isEmpty():
        return once.select("row.*")
    repeated = stays("n_rows > 1").groupBy("doc", "tag").agg(F.first("row").alias("row"))
    return once.select("row.*").unionByName(repeated.select("row.*"))


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    back = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return memberships(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        back("doc").alias("doc_id"), "n_shingles", back("component").alias("component_id"),
        (F.col("doc") == F.col("component")).alias("kept"),
    )
