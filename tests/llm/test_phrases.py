"""Phrase mining: tries against dictionaries, counts against SQL on odd inputs."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from roadpulse.llm import phrase_mining
from roadpulse.llm.double_array import DoubleArray


def _sql_rows(docs, least):
    con = duckdb.connect()
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    columns = list(zip(*rows)) or [(), (), ()]
    types = (pa.int64(), pa.string(), pa.string())
    con.register("documents", pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text", "lang"]))
    sql = phrase_mining.SQL.replace(f"f >= {phrase_mining.LEAST}", f"f >= {least}")
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(con.sql(f"select {', '.join(names)} from ({sql})").fetchall()), names


def _agree(docs, least=3):
    expected, names = _sql_rows(docs, least)
    got = phrase_mining.top_phrases(docs, least=least).select(*names)
    assert sorted(tuple(r) for r in got.collect()) == expected
    return expected


@pytest.mark.parametrize("length", [1, 2, 4])
def test_trie_finds_what_a_dictionary_finds(length):
    rng = np.random.default_rng(length)
    codes = rng.zipf(1.3, 20_000) % 5_000
    windows = np.lib.stride_tricks.sliding_window_view(codes, length)
    keys = np.unique(windows[(windows > 0).all(axis=1)], axis=0)
    keys = keys[rng.random(len(keys)) < 0.5]
    known = {tuple(k): i for i, k in enumerate(keys.tolist())}
    starts, numbers = DoubleArray.build(keys).walk(codes, np.arange(len(codes)), length)
    got = dict(zip(starts.tolist(), numbers.tolist()))
    assert got == {i: known[tuple(w)] for i, w in enumerate(windows.tolist()) if tuple(w) in known}


def test_trie_of_one_key_and_sparse_numbers():
    trie = DoubleArray.build(np.array([[5_000_000, 1, 4_000_000]]))
    codes = np.array([1, 5_000_000, 1, 4_000_000, 5_000_000, 1])
    assert [x.tolist() for x in trie.walk(codes, np.arange(6), 3)] == [[1], [0]]
    trie = DoubleArray.build(np.array([[3, 7]]))  # numbers beyond the last place lead nowhere
    assert [x.tolist() for x in trie.walk(np.array([3, 9, 3, 7]), np.arange(4), 2)] == [[2], [0]]


def test_odd_rows(make_docs, odd_rows):
    assert _agree(make_docs(odd_rows))


def test_pieces_languages_and_covered_phrases(spark):
    rows = [(i, "one two three. One two; one two three four five", "en") for i in range(4)]
    rows += [(i, "one two\tthree one,two three", None) for i in range(5)] + [(9, "x\ny " * 9, "aa"), (9, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = _agree(docs)
    assert ("und", "two three") in {(r[0], r[2]) for r in found}


def test_empty_table(make_docs):
    assert phrase_mining.top_phrases(make_docs([])).count() == 0


def test_many_small_tries_dictionaries_and_blocks(spark, monkeypatch):
    random.seed(5)
    words = [f"w{i}" for i in range(12)] + ["é", "漢", "."]
    rows = [(i, " ".join(random.choices(words, k=120)), random.choice(["a", "b"])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    small = {"DICTIONARY": 7, "TRIE_PHRASES": 50, "PASS_TRIES": 2, "BLOCK_CODES": 500, "PAIRS_HELD": 300, "SEGMENT": 64}
    for name, value in small.items():
        monkeypatch.setattr(phrase_mining, name, value)
    assert len(_agree(docs, least=5)) > 100


def test_top_with_ties_across_the_edge(spark, monkeypatch):
    rows = [(1, ". ".join(f"a{i} b{i}" for i in range(40)), "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = phrase_mining.top_phrases(docs, top=10, least=3).orderBy("rank").collect()
    first = sorted(f"a{i} b{i}" for i in range(40))[:10]
    assert [(r["rank"], r.phrase, r.score) for r in got] == [(i, p, 1_000_000) for i, p in enumerate(first, 1)]


def test_scores_beyond_64_bits(spark):
    big = 5 * 10**13
    rows = [([1, 2], big), ([1], big + 1), ([2], big + 3)]
    phrases = spark.createDataFrame(rows, "codes array<int>, f long")
    assert [r.score for r in phrase_mining.scored(phrases).collect()] == [2_000_000 * big // (2 * big + 4)]


def test_texts_are_numbered_and_packed_in_one_python_step(spark, monkeypatch):
    """Each Python step of a stage keeps a worker of its own per core."""
    plans, staged = {}, phrase_mining.staged

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, label)

    monkeypatch.setattr(phrase_mining, "staged", seen)
    docs = spark.createDataFrame([(i, "one two three", "en") for i in range(3)], "doc_id long, text string, lang string")
    _agree(docs)
    assert plans["blocks"].count("MapInArrow") == 1
    assert "Pandas" not in plans["tries"]


def test_counts_leave_python_in_parts():
    """An executor holds a whole batch from Python outside its heap."""
    block = np.random.default_rng(7).integers(1, 2**30, 200_000).astype("<i4")
    batch = pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], names=["codes"])
    parts = list(phrase_mining._count_pairs(iter([batch])))
    assert max(p.num_rows for p in parts) <= 1 << 16
    got = pa.Table.from_batches(parts)
    pairs = np.unique((block[:-1].astype(np.int64) << 32) | block[1:], return_counts=True)
    assert all((got[c].to_numpy() == x).all() for c, x in zip(("pair", "f"), pairs))


def test_tries_are_fed_in_large_batches(spark, monkeypatch):
    """Blocks come in batches of BATCH_BLOCKS rows, for they are long; phrases are short."""
    sizes, staged = {}, phrase_mining.staged

    def seen(df, label):
        sizes[label] = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return staged(df, label)

    monkeypatch.setattr(phrase_mining, "staged", seen)
    docs = spark.createDataFrame([(i, "one two three", "en") for i in range(3)], "doc_id long, text string, lang string")
    _agree(docs)
    assert sizes["tries"] >= 1_000 > sizes["counts"] == phrase_mining.BATCH_BLOCKS


def test_rows_from_python_do_not_grow_with_the_phrases(spark, monkeypatch):
    """Whatever becomes of a position, few rows leave Python for a block, and each frequent phrase is one row."""
    made, frame = {}, type(spark.range(0))
    plain = frame.mapInArrow

    def counted(self, func, schema, *args, **kwargs):
        total = spark.sparkContext.accumulator(0)
        names = [c.split()[0] for c in schema.split(", ")]
        made[tuple(names)] = [*made.get(tuple(names), []), total]

        def run(batches):
            for batch in func(batches):
                total.add(batch.num_rows)
                yield batch

        return plain(self, run, schema, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    random.seed(8)
    words = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join(random.choices(words, k=500)), "x") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    # Pairs and triples are frequent (30,000 positions over 2,744 triples), nearly all of 38,416 quadruples are not.
    assert _agree(docs)
    most = {names: max(t.value for t in totals) for names, totals in made.items()}
    del most["lang", "word", "f"]  # a row per word
    assert len(most) > 1 and max(most.values()) <= 100


def test_words_whose_phrases_lie_in_several_passes(spark, monkeypatch):
    """A pass has some of the phrases that begin with its first and its last word."""
    rows = [(i, ". ".join(f"a b{j} a b{j + 1} c" for j in range(12)), "x") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(phrase_mining, "TRIE_PHRASES", 3)
    monkeypatch.setattr(phrase_mining, "PASS_TRIES", 1)
    assert 4 in {len(r[2].split()) for r in _agree(docs)}
