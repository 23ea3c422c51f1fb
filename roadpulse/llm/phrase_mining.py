"""Phrases that occur often and hold together, by counting with double-array tries.

Per language, phrases of 2 to 4 words found at least ``least`` times are scored by the weakest
place at which they can be cut. Words that are rare themselves cannot be part of such a phrase,
so texts become arrays of the numbers of frequent words, with 0 where a phrase cannot go on (a rare
word, the end of a piece or a text), staged once as blocks of some 250,000.

Level by level (Apriori): a phrase of k words can be frequent only where both its first and its
last k - 1 words are. The frequent phrases of k - 1 words make double-array tries of at most
TRIE_PHRASES phrases each, which begin with a range of words. A task moves the states of all
positions of a block on together, word by word; a candidate is an accepting state with the word
after it, one step further in the trie, and is counted under both numbers in one. For pairs the
first number is that of a word. Counts are combined within tasks, dealt out in packed arrays to
parts of some PART_PHRASES by a hash of the phrase, and summed there, so no row is made of a
phrase that is not frequent. Tries are built in tasks; a pass over the blocks broadcasts at most
PASS_TRIES of them, and where there are more, there are more passes, each of which counts what
begins with its own words. A position has one candidate at most, over all passes.

What a broadcast holds is bounded by these constants, and so are the dictionaries with which texts
are numbered (DICTIONARY words to a pass). Nothing is gathered by language or by word.

Defined cases. A null or empty text has no words. A null ``lang`` is ``und``. Repeated rows
count each. ``doc_id`` is not read, nor are other columns. An empty table has no phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import arrow_batches, cut_bytes, running_total, staged, whole_text
from roadpulse.llm.double_array import DoubleArray

LEAST = 30
LONGEST = 4
TOP = 2000
COVER = 80  # per cent of its occurrences inside a longer phrase that drop a phrase
SCALE = 2_000_000

DICTIONARY = 1_000_000
TRIE_PHRASES = 50_000
PASS_TRIES = 10
BLOCK_CODES = 1 << 18
PAIRS_HELD = 1 << 19
PART_PHRASES = 1 << 19
PACKED = 1 << 22
WORDS_HELD = 250_000
BATCH_ROWS = 256
BATCH_BLOCKS = 4
BATCH_PHRASES = 10_000
OUT_ROWS = 1 << 16
SEGMENT = 1 << 22
SALTS = 32

_BREAK = b"."
# A-Z become lower case, what ends a piece becomes a line break, a tab becomes a space.
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" "
)


def words_and_breaks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text with a full stop wherever a piece ends; a long text in several lists."""
    for cut in cut_bytes(text.translate(_FOLD), SEGMENT):
        yield cut.replace(b"\n", b" . ").split()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        whole_text(F.col("text")).cast("binary").alias("text"),
    )


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of OUT_ROWS: an executor holds what Python hands it outside its heap, a batch at a time."""
    return (batch.slice(low, OUT_ROWS) for low in range(0, batch.num_rows, OUT_ROWS))


# --- words


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            counts.pop(_BREAK, None)
            arrays = [
                pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()),
                pa.array(list(counts.values()), pa.int64()),
            ]
            yield from _parts(pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "f"]))
        held.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            counts = held.setdefault(lang, Counter())
            for some in words_and_breaks(text):
                counts.update(some)
        if sum(map(len, held.values())) > WORDS_HELD:
            yield from out()
    yield from out()


def _coder(dictionary: Callable[[], pa.Table], keep: bool) -> Callable:
    """Fills in the numbers of the words of one dictionary; ``keep`` hands the texts on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, dict[bytes, int]] = {}
        table = dictionary()
        for lang, word, code in zip(*(table[c].to_pylist() for c in ("lang", "word", "code"))):
            number.setdefault(lang, {})[word] = code
        for batch in batches:
            codes = []
            before = batch["codes"].to_pylist() if "codes" in batch.schema.names else None
            for i, (lang, text) in enumerate(zip(batch["lang"].to_pylist(), batch["text"].to_pylist())):
                own = number.get(lang, {})
                flat = [np.fromiter(map(own.get, some, repeat(0)), "<i4", len(some)) for some in words_and_breaks(text)]
                flat = flat[0] if len(flat) == 1 else np.concatenate(flat)
                if before is not None:
                    flat = np.maximum(flat, np.frombuffer(before[i], "<i4"))
                codes.append(flat.tobytes())
            columns = [pa.array(codes, pa.binary())]
            names = ["codes"]
            if keep:
                columns, names = [batch["lang"], batch["text"], *columns], ["lang", "text", *names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays of many texts in a row, a 0 between them, runs of 0 made one and lone words left out."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        block = np.concatenate([np.zeros(1, "<i4"), *held])
        held.clear()
        word = block > 0
        beside = np.zeros(len(block), bool)
        beside[1:] |= word[:-1]
        beside[:-1] |= word[1:]
        block = np.where(word & ~beside, 0, block)
        word = block > 0
        kept = word | np.concatenate([[True], word[:-1]])
        return pa.RecordBatch.from_arrays([pa.array([block[kept].tobytes()], pa.binary())], names=["codes"])

    for batch in batches:
        for codes in batch["codes"].to_pylist():
            held += [np.frombuffer(codes, "<i4"), np.zeros(1, "<i4")]
            size += len(codes) // 4 + 1
            if size >= BLOCK_CODES:
                yield out()
                size = 0
    if held:
        yield out()


def _then(first: Callable, second: Callable) -> Callable:
    """Both in one Python worker: two steps of a plan would take, and keep, two for each core."""
    return lambda batches: second(first(batches))


class _Shared:
    """A bounded table as a broadcast that tasks read; dropped once its pass is written."""

    def __init__(self, df: DataFrame):
        self.broadcast = df.sparkSession.sparkContext.broadcast(_packed(df.toArrow()))

    def reader(self) -> Callable[[], pa.Table]:
        shared = self.broadcast
        return lambda: pa.ipc.open_stream(shared.value).read_all()

    def drop(self) -> None:
        self.broadcast.destroy()


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _coded(docs: DataFrame, vocabulary: DataFrame, n_words: int) -> DataFrame:
    """(codes): blocks of the texts' frequent words."""
    texts = _texts(docs)
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        for low in range(0, max(n_words, 1), DICTIONARY):
            part = vocabulary.where(F.col("code").between(low + 1, low + DICTIONARY))
            last = low + DICTIONARY >= n_words
            shared = _Shared(part.select("lang", "word", "code"))
            coder = _coder(shared.reader(), keep=not last)
            if last:
                coded = texts.mapInArrow(_then(coder, _blocks), "codes binary")
            else:
                coded = texts.mapInArrow(coder, "lang string, text binary, codes binary")
            texts = staged(coded, "blocks" if last else "coded")
            shared.drop()
    return texts


# --- levels


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return (keys[first], np.add.reduceat(counts, first)) if len(keys) else (keys, counts)


def _combined(found: Iterator[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """(name, f): the numbers found and how often, each once per task where it has room for them."""
    none = np.zeros(0, np.int64)
    keys, counts = none, none
    held: list[np.ndarray] = []

    def out() -> Iterator[pa.RecordBatch]:
        return _parts(pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=[name, "f"]))

    def combined() -> tuple[np.ndarray, np.ndarray]:
        new, n = np.unique(np.concatenate([none, *held]), return_counts=True)
        held.clear()
        return _merged(np.concatenate([keys, new]), np.concatenate([counts, n]))

    for some in found:
        held.append(some)
        if sum(map(len, held)) >= PAIRS_HELD:
            keys, counts = combined()
            if len(keys) >= PAIRS_HELD:
                yield from out()
                keys, counts = none, none
    keys, counts = combined()
    yield from out()


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for block in batch["codes"].to_pylist():
            yield np.frombuffer(block, "<i4").astype(np.int64)


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, f): both numbers of a pair in one."""

    def pairs(codes: np.ndarray) -> np.ndarray:
        both = (codes[:-1] > 0) & (codes[1:] > 0)
        return (codes[:-1][both] << 32) | codes[1:][both]

    yield from _combined(map(pairs, _blocks_of(batches)), "pair")


_PACKED = "part int, keys binary, counts binary"
_SUMMED = "key long, f long"


def _dealt(parts: int) -> Callable:
    """Counts (key, f) of a task in a row per part, which the key's hash names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = (np.concatenate([b.column(i).to_numpy() for b in held]).astype("<i8") for i in (0, 1))
            held.clear()
            mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            part = (mixed % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.uint32)
            order = np.argsort(part, kind="stable")
            part, keys, counts = part[order], keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))[: len(part)]
            ends = np.append(first[1:], len(part))
            packed = [
                pa.array(part[first].astype(np.int32)),
                *(pa.array([x[i:j].tobytes() for i, j in zip(first, ends)], pa.binary()) for x in (keys, counts)),
            ]
            yield from _parts(pa.RecordBatch.from_arrays(packed, names=["part", "keys", "counts"]))

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= PACKED:
                yield from out()
        if held:
            yield from out()

    return run


def _summed(least: int) -> Callable:
    """The keys of a part that occur often enough."""

    def run(rows: pa.Table) -> pa.Table:
        keys, counts = (
            np.concatenate([np.frombuffer(x, "<i8") for x in rows[c].to_pylist()]) for c in ("keys", "counts")
        )
        keys, counts = _merged(keys, counts)
        often = counts >= least
        return pa.table([pa.array(keys[often]), pa.array(counts[often])], ["key", "f"])

    return run


def _often(blocks: DataFrame, counting: Callable, positions: int, least: int) -> DataFrame:
    """(key, f), staged: what ``counting`` finds at ``positions`` places at most, if ``least`` times."""
    parts = max(1, -(-positions // PART_PHRASES))
    packed = blocks.mapInArrow(_then(counting, _dealt(parts)), _PACKED)
    return staged(packed.groupBy("part").applyInArrow(_summed(least), _SUMMED), "counts")


def _positions(vocabulary: DataFrame, low: int, high: int) -> int:
    """How many words of a range of numbers there are in the texts."""
    return vocabulary.where(F.col("code").between(low, high)).agg(F.sum("f")).first()[0] or 0


def _names(length: int) -> list[str]:
    return [f"c{i}" for i in range(1, length + 1)]


def _build(length: int) -> Callable:
    def run(phrases: pa.Table) -> pa.Table:
        keys = np.stack([phrases[c].to_numpy() for c in _names(length)], axis=1).astype(np.int64)
        order = np.lexsort(keys.T[::-1])
        keys, numbers = keys[order], phrases["number"].to_numpy()[order].astype(np.int64)
        trie = DoubleArray.build(keys)
        whole = (phrases["trie"][0].as_py(), int(keys[0, 0]), int(keys[-1, 0]), trie.digits)
        row = (*whole, *(x.tobytes() for x in (trie.base, trie.check, trie.number, numbers)))
        columns = [c.split() for c in _TRIE.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        return pa.table([pa.array([v], kinds[k]) for v, (_, k) in zip(row, columns)], [n for n, _ in columns])

    return run


_TRIE = "trie long, low int, high int, digits int, base binary, check binary, number binary, numbers binary"


def _tries(phrases: DataFrame, length: int) -> DataFrame:
    """A row per trie of TRIE_PHRASES phrases (c1 .., number, f)."""
    dealt = phrases.withColumn("trie", F.floor(F.col("number") / TRIE_PHRASES))
    with arrow_batches(phrases.sparkSession, BATCH_PHRASES):  # not by the few rows that blocks come in
        return staged(dealt.groupBy("trie").applyInArrow(_build(length), _TRIE), "tries")


class _Tries:
    """The tries of one pass, as tasks see them. Each holds a range of first words."""

    def __init__(self, table: pa.Table):
        self.tries, self.numbers = [], []
        for i in range(table.num_rows):
            # The arrays lie in the broadcast itself, no second copy is made of them.
            at = lambda name, kind: np.frombuffer(table[name][i].as_buffer(), kind)  # noqa: E731, B023
            trie = DoubleArray(
                at("base", np.int32), at("check", np.int32), at("number", np.int32), table["digits"][i].as_py()
            )
            self.tries.append((trie, table["low"][i].as_py(), table["high"][i].as_py()))
            self.numbers.append(at("numbers", np.int64))

    def walk(self, codes: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per trie the (starts, numbers) of its phrases in a block, from the positions whose word it may
        begin with."""
        # All words are above 0; of a pass's tries, only positions within their words are sorted.
        least, most = min(low for _, low, _ in self.tries), max(high for _, _, high in self.tries)
        starts = np.flatnonzero((codes >= least) & (codes <= most))
        starts = starts[np.argsort(codes[starts], kind="stable")]
        first = codes[starts]
        for trie, low, high in self.tries:
            own = starts[np.searchsorted(first, low, "left") : np.searchsorted(first, high, "right")]
            yield trie.walk(codes, own, length)


def _passes(tries: DataFrame) -> Iterator[DataFrame]:
    """The tries, as many at a time as are broadcast together."""
    last = tries.agg(F.max("trie")).first()[0]
    for low in range(0, -1 if last is None else last + 1, PASS_TRIES):
        yield tries.where(F.col("trie").between(low, low + PASS_TRIES - 1))


def _count_longer(length: int, frequent: Callable[[], pa.Table], after: int, before: int) -> Callable:
    """(key, f): phrases of ``length`` words, as the number of the frequent phrase they begin with
    and their last word, unless what follows their first word is known not to be frequent: the
    tries have all frequent phrases that begin with words between ``after`` and ``before``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = _Tries(frequent())

        def candidates(codes: np.ndarray) -> np.ndarray:
            number = np.full(len(codes) + 1, -1, np.int64)
            number[:-1][(codes > 0) & ((codes <= after) | (codes >= before))] = 0  # perhaps frequent
            at = []
            for (starts, found), numbers in zip(tries.walk(codes, length - 1), tries.numbers):
                number[starts] = numbers[found]
                at.append(starts)
            at = np.concatenate(at)
            at = at[at <= len(codes) - length]
            at = at[(number[at + 1] >= 0) & (codes[at + length - 1] > 0)]
            return (number[at] << 32) | codes[at + length - 1]

        yield from _combined(map(candidates, _blocks_of(batches)), "key")

    return run


def _numbered(phrases: DataFrame, length: int) -> DataFrame:
    return running_total(phrases, _names(length), F.lit(1), "number")


def _level(blocks: DataFrame, vocabulary: DataFrame, shorter: DataFrame, length: int, least: int) -> DataFrame:
    """Frequent phrases of ``length`` words (c1 .., f, number), from the frequent ones of one less."""
    names = _names(length)
    counts = None
    passes = list(_passes(_tries(shorter, length - 1)))
    for i, one in enumerate(passes):
        low, high = one.agg(F.min("low"), F.max("high")).first()
        shared = _Shared(one)
        # The phrases of a word may lie in two passes; before the first and after the last there are none.
        between = low if i else 0, high if i < len(passes) - 1 else 2**31
        counting = _count_longer(length, shared.reader(), *between)
        part = _often(blocks, counting, _positions(vocabulary, low, high), least)
        shared.drop()
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        schema = ", ".join(f"{c} int" for c in names)
        return blocks.sparkSession.createDataFrame([], f"{schema}, f long, number long")
    begun = counts.select(F.shiftright("key", 32).alias("number"), _last(names[-1]), "f")
    return _numbered(begun.join(shorter.drop("f"), "number").select(*names, "f"), length)


def _last(name: str) -> Column:
    return F.col("key").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias(name)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST):
    """All frequent phrases of 1 to ``longest`` words (codes array<int>, f), the vocabulary (lang,
    word, f, code) and per language the number of all words (lang, n)."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        counted = _texts(docs).mapInArrow(_count_words, "lang string, word binary, f long")
        dealt = counted.repartition("lang", "word")  # combined within tasks already
        words = staged(dealt.groupBy("lang", "word").agg(F.sum("f").alias("f")), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    vocabulary = running_total(frequent, [F.desc("f"), "lang", "word"], F.lit(1), "code")
    vocabulary = vocabulary.withColumn("code", (F.col("code") + 1).cast("int"))
    n_words = vocabulary.count()
    blocks = _coded(docs, vocabulary, n_words)
    with arrow_batches(docs.sparkSession, BATCH_BLOCKS):
        pairs = _often(blocks, _count_pairs, _positions(vocabulary, 1, n_words), least)
        first = F.shiftright("key", 32).cast("int").alias("c1")
        levels = {2: _numbered(pairs.select(first, _last("c2"), "f"), 2)}
        for length in range(3, longest + 1):
            levels[length] = _level(blocks, vocabulary, levels[length - 1], length, least)
    phrases = vocabulary.select(F.array("code").alias("codes"), "f")
    for length, found in levels.items():
        if length <= longest:
            phrases = phrases.unionByName(found.select(F.array(*_names(length)).alias("codes"), "f"))
    return staged(phrases, "phrases"), vocabulary, totals


# --- scores


def _wide(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a / (l + r)); products may pass 64 bits."""
    product = (F.lit(SCALE).cast("decimal(8,0)") * a.cast("decimal(20,0)")).cast("decimal(30,0)")
    return F.call_function("div", product, left.cast("decimal(20,0)") + right.cast("decimal(20,0)")).cast("long")


def scored(phrases: DataFrame, longest: int = LONGEST, cover: int = COVER) -> DataFrame:
    """(codes, a, l, r, score) of the phrases of two and more words that no longer one covers."""
    candidates = phrases.where(F.size("codes") > 1).withColumnRenamed("f", "a")
    cut = F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("cut")
    cuts = candidates.select("codes", "a", cut).select(
        "codes", "a", "cut",
        F.slice("codes", F.lit(1), F.col("cut")).alias("first"),
        F.slice("codes", F.col("cut") + 1, F.size("codes")).alias("rest"),
    )
    part = phrases.select(F.col("codes").alias("part"), "f")
    both = (
        cuts.join(part.withColumnsRenamed({"part": "first", "f": "l"}), "first")
        .join(part.withColumnsRenamed({"part": "rest", "f": "r"}), "rest")
        .withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    )
    weakest = both.groupBy("codes").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("w")
    )
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.size("codes") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.size("codes") - n + 1), lambda i: F.slice("codes", i, n))))
    covers = (
        candidates.where(F.size("codes") > 2).select(F.explode(inner).alias("codes"), "a")
        .groupBy("codes").agg(F.max("a").alias("inside"))
    )
    free = (100 * _wide(F.coalesce(F.col("inside"), F.lit(0)))) < cover * _wide(F.col("a"))
    return (
        weakest.join(covers, "codes", "left").where(free)
        .select("codes", "a", "w.l", "w.r", "w.score")
    )


def top_phrases(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases."""
    phrases, vocabulary, totals = frequent_phrases(docs, least, longest)
    word = vocabulary.select(F.col("code"), "lang", F.col("word").cast("string").alias("word"))
    all_ = staged(
        scored(phrases, longest).withColumn("code", F.get("codes", F.lit(0)))
        .join(word.select("code", "lang"), "code").drop("code"),
        "scored",
    )
    # The first in parts of each language, then of those the one at place ``top``: whatever
    # is not below it in score and count, ties included, is spelled out and ranked.
    best = [F.desc("score"), F.desc("a")]
    salted = all_.withColumn("_salt", F.pmod(F.xxhash64("codes"), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))
    some = salted.withColumn("_place", place).where(F.col("_place") <= top)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    at_top = some.select("lang", "score", "a").withColumn("_place", place).where(F.col("_place") <= top)
    bars = at_top.groupBy("lang").agg(F.min(F.struct("score", "a")).alias("bar"))
    bars = bars.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    chosen = staged(
        salted.join(bars, ["lang", "_salt"]).where(F.struct("score", "a") >= F.col("bar")).drop("_salt", "bar"),
        "chosen",
    )
    spelled = (
        chosen.select("codes", F.posexplode("codes").alias("at", "code")).join(word.drop("lang"), "code")
        .groupBy("codes").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("codes", F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best, F.asc("phrase")))
    return (
        chosen.join(spelled, "codes").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
        .join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = rf"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
n as (select lang, sum(len(ws))::bigint as n from w group by lang),
g as (select lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) as phrase
      from w, (select unnest([1, 2, 3, 4]) as k) where len(ws) >= k),
f as (select lang, k, phrase, count(*)::hugeint as f from g group by all),
c as (select *, string_split(phrase, ' ') as ws from f where k > 1 and f >= {LEAST}),
cuts as (select lang, phrase, k, f, cut, array_to_string(ws[1:cut], ' ') as first, array_to_string(ws[cut + 1:], ' ') as rest
         from c, (select unnest([1, 2, 3]) as cut) where cut < k),
s as (select cuts.lang, cuts.phrase, cuts.f as a, x.f as l, y.f as r, cut,
             ({SCALE} * cuts.f) // (x.f + y.f) as score
      from cuts join f x on x.lang = cuts.lang and x.phrase = first join f y on y.lang = cuts.lang and y.phrase = rest),
m as (select *, row_number() over (partition by lang, phrase order by score, cut) as place from s),
parts as (select lang, f, unnest([array_to_string(ws[i:i + j - 1], ' ') for i in range(1, k - j + 2)]) as phrase
          from c, (select unnest([2, 3]) as j) where j < k),
inside as (select lang, phrase, max(f) as f from parts group by all),
kept as (select m.* from m left join inside using (lang, phrase)
         where place = 1 and 100 * coalesce(inside.f, 0) < {COVER} * a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score
from ranked join n using (lang) where rank <= {TOP}"""
