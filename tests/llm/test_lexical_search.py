"""Ranked lexical search against SQL on odd inputs."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from roadpulse.llm import lexical_search


def _tables(docs, items):
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        columns = list(zip(*rows)) or [(), ()]
        table = pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string()))], [key, "text"])
        con.register(name, table)
    return con


def _agree(spark, make_docs, docs, items):
    con = _tables(docs, items)
    expected = con.sql(f"select item_id, rank, doc_id, score from ({lexical_search.SQL})").fetchall()
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, block string")
    got = lexical_search.search(asked, make_docs(docs)).drop("item").collect()
    key = lambda r: tuple((v is not None, v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    return expected


ITEMS = [
    (1, "This line stands"), (2, None), (3, ""), (4, "WORD word w1 w2 w3"), (5, "w1 w2 w3 w7 é"),
    (6, "nothing-of-this: zzz"), (7, "漢字🙂 and ümlauts\x85and"), (1, "This line stands"), (8, "short line other word"),
]


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [r[:2] for r in odd_rows]
    assert _agree(spark, make_docs, rows, ITEMS)


def test_ties_and_repeated_rows(spark, make_docs):
    docs = [(i % 9, "same words here") for i in range(30)] + [(None, "same words here")] * 2 + [(50, "other")]
    found = _agree(spark, make_docs, docs, [(1, "same words"), (2, "other other same")])
    assert len(found) == 20


@pytest.mark.parametrize("docs, items", [([], ITEMS), ([(1, "a b")], []), ([(1, None)], ITEMS)])
def test_empty_tables(spark, make_docs, docs, items):
    assert lexical_search.search(
        spark.createDataFrame(items, "item_id long, text string"), make_docs(docs)
    ).count() == 0


def test_many_blocks_and_batches(spark, make_docs, monkeypatch):
    for name, value in {"BLOCK_ITEMS": 7, "BLOCK_TERMS": 60, "BATCH_ROWS": 5, "SEGMENT": 32}.items():
        monkeypatch.setattr(lexical_search, name, value)
    random.seed(2)
    words = [f"t{i}" for i in range(80)]
    docs = [(i, " ".join(random.choices(words, k=random.randint(0, 60)))) for i in range(200)]
    items = [(i, " ".join(random.choices(words, k=random.randint(1, 25)))) for i in range(30)]
    _agree(spark, make_docs, docs, items)


def test_graph_gives_the_plain_sums_with_fewer_additions():
    random.seed(3)
    common = [random.sample(range(60), 8) for _ in range(6)]
    bags = []
    for _ in range(40):
        bag = {t: 1 for part in random.sample(common, 3) for t in part}
        bag |= {random.randrange(60): random.randint(1, 3) for _ in range(3)}
        bags.append(bag)
    graph = lexical_search.sharing_graph(60, bags)
    values = np.random.default_rng(0).integers(0, 10**9, 60)
    parts = list(values)
    for summed in graph.sums:
        parts.append(sum(parts[i] for i in summed))
    for bag, rows in zip(bags, graph.items):
        assert sum(values[t] * k for t, k in bag.items()) == sum(parts[i] for i in rows)
    plain = sum(sum(b.values()) for b in bags)
    assert sum(map(len, graph.sums)) + sum(map(len, graph.items)) < plain / 2
