"""Best-fit packing: ids against the tokenizer library, places against the pieces' lengths."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import best_fit_packing as packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.tokenizer_path())


def _expected(rows, library):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), packing.ROOM)):
            own = np.array(ids[start : start + packing.ROOM], "<u4").tobytes()
            out.append((doc_id, piece, start, len(own) // 4, zlib.crc32(own)))
    return sorted(out, key=str)


def _check(result, rows, library):
    found = result.collect()
    assert sorted(((*r[:5],) for r in found), key=str) == _expected(rows, library)
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in places.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= packing.ROOM
    return places



def _digests(docs):
    cut = packing.staged(packing.pieces(docs).withColumn("ids_crc32", packing.F.crc32("ids")).drop("ids"), "pieces")
    return packing.placed(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def test_given_table(spark, sf, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    places = _check(packing.op13_best_fit_packing(spark, sf), rows, library)
    total = sum(n for inside in places.values() for _, n in inside)
    assert len(places) <= -(-total // packing.ROOM) + 1


def test_odd_rows(make_docs, odd_rows, library):
    rows = [r[:2] for r in odd_rows] + [(30, "<|endoftext|> İΣς It'S ẖ \x1c'll"), (31, "a b " * 90_000)]
    _check(_digests(make_docs(rows).repartition(3)), rows, library)


def test_odd_texts_encode_as_the_library_does(library):
    random.seed(1)
    pool = list("aAzZ'sKHİΣσς019.,!?-_<>|&# \n\t\r\x0b\x1c\x85\xa0̱́éÉßÀÿµª漢字🙂Ⅷ²ﬁ") + ["'re", "'LL", " the"]
    texts = ["".join(random.choices(pool, k=random.randint(0, 20))) for _ in range(4_000)]
    plain = [t for t in ("".join(random.choices(pool[:24] + ["é", "ß", "Ñ", " the"], k=15)) for _ in range(2_000))]
    encoder = packing.WordEncoder(packing.tokenizer_path())
    for text, ids in zip(texts + plain, encoder.encode_all(texts + plain)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_empty_table(make_docs):
    assert _digests(make_docs([])).count() == 0


def test_sequences_hold_the_ids_of_their_pieces(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for row in packing.sequences(docs).collect():
        ids = np.frombuffer(row.ids, "<u4")
        for offset, length, doc_id, piece in row.pieces:
            own = library.encode(texts[doc_id], add_special_tokens=False).ids + [0]
            start = piece * packing.ROOM
            assert ids[offset : offset + length].tolist() == own[start : start + length]


def test_exact_fillings_are_found():
    counts = np.zeros(packing.ROOM + 1, np.int64)
    for lengths, n in (((1500, 548), 10), ((1000, 800, 248), 7), ((900, 700, 401, 47), 5), ((2048,), 10**12)):
        for x in lengths:
            counts[x] += n
    assert sum(times for _, times in packing.patterns(counts, packing.ROOM)) == 22 + 10**12


@pytest.mark.parametrize("low, high, spare", [(1, 2048, 0.005), (5, 300, 0.001), (600, 700, 0.01)])
def test_few_sequences(low, high, spare):
    lengths = np.random.default_rng(low).integers(low, high, 20_000)
    counts = np.bincount(lengths, minlength=packing.ROOM + 1)
    used = np.zeros_like(counts)
    n = 0
    for contents, times in packing.patterns(counts, packing.ROOM):
        assert sum(x * k for x, k in contents.items()) <= packing.ROOM
        for x, k in contents.items():
            used[x] += k * times
        n += times
    assert (used == counts).all()
    per = packing.ROOM // low
    bound = max(-(-int(lengths.sum()) // packing.ROOM), (lengths > packing.ROOM // 2).sum(), len(lengths) // per)
    assert n <= bound * (1 + spare) + 1
