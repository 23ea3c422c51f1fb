"""Best-fit packing of token sequences by exact-complement hashing.

Every document is its token ids and one closing id. Longer ones than a sequence are cut into
whole sequences and a rest; what comes out are *pieces*. Pieces of one length are alike, so
packing works on how many there are of each length (``room`` numbers, however many documents):

1. The longest piece left opens a sequence. Its gap is looked up in indices of the lengths that
   are left, addressed by their sum: one piece, a pair, or three pieces that fill it exactly.
2. A gap without an exact complement takes the piece that fits it best, the longest one not
   above it, and what remains of the gap is looked up again.
3. The contents found are used for as many sequences as the scarcest length allows at once.

The outcome is a list of *runs*: pieces number lo to hi of one length lie in consecutive
sequences at one offset. There are at most a few thousand, whatever the size of the corpus; the
driver makes them from the counts and tasks look their pieces up by binary search. Pieces get
their number within their length from their place in the staged table and running counts
per writing task, so no length is ever gathered in one place.

Defined cases. A null or empty text is the closing id alone. Repeated rows are packed once
each. A null ``doc_id`` stays null. An empty table has no pieces. Other columns are not read.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import arrow_batches, staged, whole_text

ROOM = 2048
CLOSING_ID = 0
BATCH_ROWS = 256
SEGMENT = 1 << 18  # characters of a text that are looked at together
CACHE = 600_000  # words whose ids a task remembers
TOGETHER = 256  # new words that go to the tokenizer as one text
ID_BYTES = 4
_RANK_BITS = 50


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- token ids


def _segments(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > SEGMENT:
        end = text.find(" ", start + SEGMENT)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


# Texts of printable ASCII and the letters of Latin-1: each letter has one form, so they may be
# lower-cased and split into words as the tokenizer does it. Others go to the tokenizer whole.
_PLAIN = re.compile("[ \\n\\t\\r!-~À-ÖØ-öø-ÿ]*")
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \\n\\t\\r]+")


class WordEncoder:
    """Token ids of texts, from the ids of their words.

    The tokenizer merges within words alone, so a text's ids are those of its words in a row.
    Words seen before are looked up; new ones go to the tokenizer many at a time, their ids
    being told apart by the tokens that end a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])

    def _by_library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
        return np.array(found.ids, "<u4").tobytes()

    def _learn(self, new: list[str]) -> None:
        groups = [new[i : i + TOGETHER] for i in range(0, len(new), TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, joined):
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * ID_BYTES
            if len(ends) != len(group):
                raise ValueError("the tokenizer splits words in another way than this encoder")
            flat, at = ids.tobytes(), 0
            for word, end in zip(group, ends.tolist()):
                self.ids[word] = flat[at:end]
                at = end

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian and of 32 bits."""
        words = [_WORD.findall(t.lower()) if _PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        if len(self.ids) > CACHE:
            self.ids.clear()
        known = self.ids
        new = [w for w in {w for ws in words if ws for w in ws} if w not in known]
        if new:
            self._learn(new)
        return [
            self._by_library(t) if ws is None else b"".join([known[w] for w in ws])
            for t, ws in zip(texts, words)
        ]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """As ``encode``; long texts are cut at spaces, odd ones left to the tokenizer in such cuts."""
        cuts = [list(_segments(t)) for t in texts]
        ids = iter(self.encode([c for cs in cuts if len(cs) == 1 for c in cs]))
        return [next(ids) if len(cs) == 1 else b"".join(self.encode([c])[0] for c in cs) for cs in cuts]


def _pieces_of(path: str, closing: int, room: int) -> Callable:
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids", pa.binary()), ("part", pa.int32()), ("nth", pa.int64()),
    ]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part = WordEncoder(path), TaskContext.get().partitionId()
        seen, last = np.zeros(room + 1, np.int64), closing.to_bytes(ID_BYTES, "little")
        for batch in batches:
            columns: list[list] = [[] for _ in fields]
            found = encoder.encode_all(batch["text"].to_pylist())
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), found):
                ids += last
                for piece, start in enumerate(range(0, len(ids) // ID_BYTES, room)):
                    own = ids[start * ID_BYTES : (start + room) * ID_BYTES]
                    length = len(own) // ID_BYTES
                    row = (doc_id, piece, start, length, own, part, seen[length])
                    seen[length] += 1
                    for column, value in zip(columns, row):
                        column.append(value)
            arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"


def pieces(docs: DataFrame, path: str | None = None, closing: int = CLOSING_ID, room: int = ROOM) -> DataFrame:
    """(doc_id, piece, start, length, ids, part, nth): little-endian 32-bit ids; ``nth`` counts the
    pieces of one length within the task ``part``. To be staged before ``nth`` is used."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return texts.mapInArrow(_pieces_of(path or tokenizer_path(), closing, room), PIECES)


# --- the plan


class SumIndex:
    """Lengths that are left, addressed by what one, two or three of them add up to.

    Which pairs of lengths make a sum changes only where a length has run out, so the table of
    pair sums is made anew then. A hit is checked against the counts: a piece may be set aside.
    """

    def __init__(self, left: np.ndarray):
        self.left, self.there, self.pairs = left, None, None

    def refresh(self) -> None:
        there = self.left > 0
        if self.there is None or (there != self.there).any():
            self.there = there
            self.pairs = np.convolve(there.astype(np.float64), there.astype(np.float64)) > 0.5

    def two(self, total: int) -> tuple[int, ...] | None:
        if not self.pairs[total]:
            return None
        left = self.left
        longer = np.arange(total - 1, (total - 1) // 2, -1)
        fits = (left[longer] > 0) & (left[total - longer] > 0) & ((2 * longer != total) | (left[longer] > 1))
        if not fits.any():
            return None
        at = int(longer[fits.argmax()])
        return at, total - at

    def three(self, total: int) -> tuple[int, ...] | None:
        longest = np.arange(total - 2, (total + 2) // 3 - 1, -1)
        for at in longest[(self.left[longest] > 0) & self.pairs[total - longest]].tolist():
            self.left[at] -= 1
            rest = self.two(total - at)
            self.left[at] += 1
            if rest:
                return at, *rest
        return None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """Pieces that fill the gap exactly, as few as possible, the longest first."""
        return (gap,) if self.left[gap] else self.two(gap) or (self.three(gap) if gap > 2 else None)


def patterns(counts: np.ndarray, room: int) -> list[tuple[dict[int, int], int]]:
    """(length -> pieces in a sequence, number of such sequences), until no piece is left."""
    left = counts.astype(np.int64).copy()
    index, found = SumIndex(left), []
    for length in range(room, 0, -1):
        while left[length]:
            index.refresh()
            used, gap = [length], room - length
            left[length] -= 1
            while gap:
                exact = index.fill(gap)
                shorter = np.flatnonzero(left[: gap + 1]) if exact is None else ()
                now = exact or (int(shorter[-1]),) if exact or len(shorter) else ()
                if not now:
                    break
                for x in now:
                    left[x] -= 1
                used += now
                gap -= sum(now)
            contents = Counter(used)
            times = 1 + min(int(left[x]) // k for x, k in contents.items())
            for x, k in contents.items():
                left[x] -= k * (times - 1)
            found.append((dict(contents), times))
    return found


def runs_of(counts: np.ndarray, room: int = ROOM) -> np.ndarray:
    """Where pieces go: rows (length, lo, each, sequence, offset), ordered by length and lo.

    The pieces of ``length`` from number ``lo`` up to the next row's lie ``each`` to a sequence,
    one after the other from ``offset``, in ``sequence`` and those after it.
    """
    taken, sequence, rows = Counter(), 0, []
    for contents, times in patterns(counts, room):
        offset = 0
        for length in sorted(contents, reverse=True):
            each = contents[length]
            rows.append((length, taken[length], each, sequence, offset))
            taken[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _places(runs: np.ndarray) -> Callable:
    keys = (runs[:, 0] << _RANK_BITS) + runs[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch["length"].to_numpy(), batch["number"].to_numpy()
            row = runs[np.searchsorted(keys, (length << _RANK_BITS) + number, "right") - 1]
            past, each = number - row[:, 1], row[:, 2]
            kept = [n for n in batch.schema.names if n != "number"]
            places = [pa.array(row[:, 3] + past // each), pa.array(row[:, 4] + past % each * length)]
            names = [*kept, "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in kept), *places], names=names)

    return run


def placed(cut: DataFrame, room: int = ROOM) -> DataFrame:
    """Staged pieces (length, part, nth and whatever else) with ``sequence_id`` and ``offset``."""
    counts = staged(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    per_length = np.zeros(room + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most ``room`` rows
        per_length[length] = n
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = cut.join(before, ["length", "part"]).select(
        *[c for c in cut.columns if c not in ("part", "nth")], (F.col("nth") + F.col("before")).alias("number")
    )
    kept = ", ".join(f"{n} {t}" for n, t in numbered.drop("number").dtypes)
    return numbered.mapInArrow(_places(runs_of(per_length, room)), f"{kept}, sequence_id long, offset long")


def sequences(docs: DataFrame, path: str | None = None, closing: int = CLOSING_ID, room: int = ROOM) -> DataFrame:
    """(sequence_id, ids, pieces): the packed ids and (offset, length, doc_id, piece) of what is in them."""
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        cut = staged(pieces(docs, path, closing, room), "pieces")
    inside = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids")))
    joined = F.aggregate("inside", F.lit(b"").cast("binary"), lambda all_, x: F.concat(all_, x["ids"]))
    parts = F.transform("inside", lambda x: x.dropFields("ids"))
    return (
        placed(cut, room).groupBy("sequence_id").agg(inside.alias("inside"))
        .select("sequence_id", joined.alias("ids"), parts.alias("pieces"))
    )


def op13_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digests = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    with arrow_batches(spark, BATCH_ROWS):
        cut = staged(digests, "pieces")
    return placed(cut).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
