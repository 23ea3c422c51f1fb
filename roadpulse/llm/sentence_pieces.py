"""SentencePiece encoding by vectorised merge rounds, and decoding.

A batch's texts are cut into words (a word: spaces and what follows up to the next
space; the vocabulary has no piece with a space behind another character, which is
checked, so no merge crosses a cut). The distinct words become one flat array of symbols.
Each round finds the best rank in every word (a segmented minimum over neighbouring
pairs), merges there in all words at once, leftmost first, and compacts the arrays, until
no pair is left. All equal pairs of a word merge in one round where no later piece that
contains the merged one has a better or equal rank; else only the leftmost does, which is
the order in which one merge at a time would go.

Characters outside the vocabulary become byte pieces. Ids of frequent words are kept for
the next batches of the task, in two generations of at most KEPT_WORDS.

Defined cases. A null text is an empty one and has no ids. Texts are cut into chunks of
CHUNK characters at word borders, so one very long text takes no more memory than many
short ones but for its own string. Repeated rows are encoded each on its own; a null
``doc_id`` is passed on; other columns are carried along untouched.

The model file is a parameter; a task loads it once from ``model_path``, which every
executor must be able to read (a path of the executor's own installation, or a file
shipped with ``SparkContext.addFile``).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.llm.common import whole_text

SPACE = "▁"
CHUNK = 1 << 20
BATCH = 256
KEPT_WORDS = 120_000
KEPT_CHARS = 40
NO_PAIR = np.int64(2**62)
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """Vocabulary of a BPE model with byte fallback, as arrays."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(n)]
        plain = [
            i for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.ids = {text[i]: i for i in plain}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("a piece has a space behind another character")
        score = np.array([model.get_score(i) for i in range(n)])
        # Rank 0 merges first; equal scores share a rank.
        order = {s: r for r, s in enumerate(sorted({float(score[i]) for i in plain}, reverse=True))}
        rank = np.full(n, len(order), np.int64)
        for i in plain:
            rank[i] = order[float(score[i])]
        left, right, merged = [], [], []
        self.alone = np.zeros(n, bool)  # merged one at a time
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                for part in (a, b):
                    if part is not None and rank[i] <= rank[part]:
                        self.alone[part] = True
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        key = np.array(left, np.int64) * n + np.array(right, np.int64)
        at = np.argsort(key)
        self.size, self.key, self.merged = n, key[at], np.array(merged, np.int64)[at]
        self.rank = rank
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        raw = [b""] * n
        for b in range(256):
            raw[self.bytes[b]] = bytes([b])
        for piece, i in self.ids.items():
            raw[i] = piece.replace(SPACE, " ").encode()
        self.raw = raw
        # Symbol of every code point: its piece, or -1 - code point.
        self.of_point = -1 - np.arange(0x110000, dtype=np.int64)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.of_point[ord(piece)] = i
        self.names = [str(i) for i in range(n)]
        runs = [len(p) for p in self.ids if not p.strip(SPACE)]
        self.run = max(runs, default=0)  # spaces in the longest piece of spaces
        longest = self.ids.get(SPACE * self.run)
        self.cut_runs = self.run > 1 and self.merge([SPACE * (3 * self.run)])[0].tolist() == [longest] * 3

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_PAIR if none) and id of each merged pair; symbols below 0 merge with none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        ok = (self.key[at] == key) & (left >= 0) & (right >= 0)
        piece = self.merged[at]
        return np.where(ok, self.rank[piece], NO_PAIR), piece

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each word has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbol = self.of_point[points]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbol), NO_PAIR)
        piece = np.zeros(len(symbol), np.int64)
        rank[:-1], piece[:-1] = self._pairs(symbol[:-1], symbol[1:])
        rank[:-1][word[1:] != word[:-1]] = NO_PAIR
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[starts, len(symbol)])
            best = np.minimum.reduceat(rank, starts)
            over = best == NO_PAIR
            if over.any():
                out = np.repeat(over, lengths)
                ready.append((symbol[out], word[out]))
                keep = ~out
                symbol, word, rank, piece = symbol[keep], word[keep], rank[keep], piece[keep]
                best, lengths = best[~over], lengths[~over]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(best, lengths))
            at = at[self._chosen(at, word[at], piece[at])]
            symbol[at] = piece[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            symbol, word, rank, piece = symbol[keep], word[keep], rank[keep], piece[keep]
            at = at - np.arange(len(at))  # places after compaction
            # Only pairs that begin at a merged symbol or just before it have changed.
            changed = np.zeros(len(symbol), bool)
            changed[at] = True
            changed[at[at > 0] - 1] = True
            rank[changed] = NO_PAIR
            changed[-1] = False
            inner = np.flatnonzero(changed)
            inner = inner[word[inner] == word[inner + 1]]
            rank[inner], piece[inner] = self._pairs(symbol[inner], symbol[inner + 1])
        return self._with_bytes(ready, len(words))

    def _with_bytes(self, ready: list, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Finished symbols in word order; one outside the vocabulary gives an id per byte."""
        symbol = np.concatenate([r[0] for r in ready]) if ready else np.zeros(0, np.int64)
        word = np.concatenate([r[1] for r in ready]) if ready else np.zeros(0, np.int64)
        order = np.argsort(word, kind="stable")
        symbol, word = symbol[order], word[order]
        unknown = np.flatnonzero(symbol < 0)
        if len(unknown):
            parts = [chr(-1 - s).encode() for s in symbol[unknown].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[unknown] = [len(b) for b in parts]
            known = np.repeat(symbol >= 0, times)
            symbol, word = np.repeat(symbol, times), np.repeat(word, times)
            symbol[~known] = self.bytes[np.frombuffer(b"".join(parts), np.uint8)]
        return symbol, np.bincount(word, minlength=n_words)

    def _chosen(self, at: np.ndarray, word: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Which of the best pairs merge now: every other one of an overlapping run, leftmost
        first; but only a word's first where its piece (or a tie of several) asks for it."""
        new_word = np.r_[True, word[1:] != word[:-1]]
        new_run = new_word | np.r_[True, at[1:] != at[:-1] + 1]
        index = np.arange(len(at))
        place = index - np.maximum.accumulate(np.where(new_run, index, 0))
        chosen = place % 2 == 0
        group = np.cumsum(new_word) - 1
        careful = np.zeros(group[-1] + 1, bool)
        np.logical_or.at(careful, group, self.alone[piece])
        return np.where(careful[group], new_word, chosen)

    def _units(self, text: str) -> list[str]:
        if not self.cut_runs or SPACE * (3 * self.run) not in text:
            return _WORD.findall(text)
        out = []
        for unit in _WORD.findall(text):
            spaces = len(unit) - len(unit.lstrip(SPACE))
            whole = max(0, spaces // self.run - 1)  # a run longer than any piece fills up from the left
            out += [SPACE * self.run] * whole
            out.append(unit[whole * self.run :])
        return out

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The words of a text, some CHUNK characters at a time."""
        if not text:
            return
        text = SPACE + text.replace(" ", SPACE)
        low = 0
        while low < len(text):
            high = low + CHUNK
            while high < len(text) and not (text[high] == SPACE and text[high - 1] != SPACE):
                following = text.find(SPACE, high + 1)
                high = following if following > 0 else len(text)
            yield self._units(text[low:high])
            low = high

    def decode_bytes(self, ids) -> bytes:
        """The bytes of the pieces, without the space that encoding puts in front."""
        out = b"".join([self.raw[i] for i in ids])
        return out[1:] if out[:1] == b" " else out

    def decode(self, ids) -> str:
        return self.decode_bytes(ids).decode(errors="replace")


class Encoder:
    """Encodes texts in batches; what frequent words give is kept for the next ones."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.known: dict[str, tuple[str, bytes]] = {}
        self.earlier: dict[str, tuple[str, bytes]] = {}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """The ids of each text."""
        cut = [[w for chunk in self.pieces.chunks(t or "") for w in chunk] for t in texts]
        words = list(dict.fromkeys(w for units in cut for w in units))
        ids, counts = self.pieces.merge(words)
        ends = np.cumsum(counts).tolist()
        ids, of = ids.tolist(), {}
        for word, low, high in zip(words, [0, *ends], ends):
            of[word] = ids[low:high]
        return [[i for w in units for i in of[w]] for units in cut]

    def _learn(self, words: set[str]) -> dict[str, tuple[str, bytes]]:
        """Per word its ids in decimal with commas, and the bytes of their pieces."""
        p, known, earlier, found, new = self.pieces, self.known, self.earlier, {}, []
        for w in words:
            entry = known.get(w)
            if entry is None:
                entry = earlier.get(w)
                if entry is None:
                    new.append(w)
                    continue
                known[w] = entry
            found[w] = entry
        ids, counts = p.merge(new)
        ends, ids = np.cumsum(counts).tolist(), ids.tolist()
        names = [p.names[i] for i in ids]
        raw = [p.raw[i] for i in ids]
        low = 0
        for word, high in zip(new, ends):
            found[word] = entry = (",".join(names[low:high]), b"".join(raw[low:high]))
            if len(word) <= KEPT_CHARS:
                known[word] = entry
            low = high
        if len(known) > KEPT_WORDS:
            self.known, self.earlier = {}, known
        return found

    def digests(self, texts: list[str | None]) -> list[tuple[int, str, str]]:
        """Per text: how many ids, SHA-256 of the ids in decimal with commas, of the decoded text."""
        cut = [list(self.pieces.chunks(t or "")) if len(t or "") <= CHUNK else None for t in texts]
        shared = self._learn({w for chunks in cut if chunks for words in chunks for w in words})
        return [
            self._digest(self.pieces.chunks(text) if chunks is None else chunks, chunks and shared)
            for text, chunks in zip(texts, cut)
        ]

    def _digest(self, chunks, shared) -> tuple[int, str, str]:
        n, ids, decoded, first = 0, hashlib.sha256(), hashlib.sha256(), True
        for words in chunks:
            found = shared if shared is not None else self._learn(set(words))
            names, raw = zip(*map(found.__getitem__, words))
            names, raw = ",".join(names), b"".join(raw)
            n += names.count(",") + 1
            ids.update((names if first else "," + names).encode())
            decoded.update(raw[1:] if first and raw[:1] == b" " else raw)
            first = False
        return n, ids.hexdigest(), decoded.hexdigest()


def encoder(model_path: str) -> Encoder:
    """An encoder; a task makes one of its own and drops it when it ends."""
    return Encoder(Pieces(model_path))


def _local(model_path: str) -> str:
    """The path itself, or the file of that name that was shipped to the executors."""
    if os.path.exists(model_path):
        return model_path
    from pyspark import SparkFiles

    return SparkFiles.get(os.path.basename(model_path))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _ids_function(model_path: str):
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, kind = encoder(_local(model_path)), pa.list_(pa.int32())
        for texts in batches:
            parts = (texts.slice(low, BATCH) for low in range(0, len(texts), BATCH))
            found = [pa.array(own.encode(part.to_pylist()), kind) for part in parts]
            yield pa.concat_arrays(found) if found else pa.array([], kind)

    return ids


def encoded(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """The documents with a column ``ids``, in place of one of that name.

    Only the text goes to Python, the other columns stay where they are.
    """
    ids = _ids_function(model_path or default_model())
    others = [c for c in docs.columns if c.lower() != "ids"]
    return docs.select(*(docs[c] for c in others), ids(whole_text(F.col("text"))).alias("ids"))


def _text_mapper(model_path: str, id_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(_local(model_path)).pieces
        for batch in batches:
            texts = [pieces.decode(ids or []) for ids in batch[id_column].to_pylist()]
            names = batch.schema.names + ["decoded"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    return run


def decoded(rows: DataFrame, id_column: str = "ids", model_path: str | None = None) -> DataFrame:
    """The rows with a column ``decoded``, in place of one of that name; null ids give ''."""
    rows = rows.drop("decoded")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, decoded string"
    return rows.mapInArrow(_text_mapper(model_path or default_model(), id_column), schema)


def _digest_mapper(model_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(_local(model_path))
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                n, ids, back = zip(*own.digests(part["text"].to_pylist()))
                columns = [pa.array(n, pa.int64()), pa.array(ids), pa.array(back)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([part["doc_id"], *columns], names)

    return run


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Per document: the number of ids, digests of the ids and of the text decoded from them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(
        _digest_mapper(model_path or default_model()),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )


def op7_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
