"""The pipeline against a plain version of each stage, fed with the same documents."""

import duckdb
import pyarrow as pa

import corpus_pipeline
from roadpulse.llm import line_dedup, mixing, quality_rules, sentence_pieces
from roadpulse.llm.common import staged


def _table(rows):
    columns = list(zip(*rows)) if rows else [()] * 3
    types = (pa.int64(), pa.string(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text", "source"])


def _sql(sql, rows):
    con = duckdb.connect()
    con.register("documents", _table(rows))
    relation = con.sql(sql)
    return [dict(zip(relation.columns, r)) for r in relation.fetchall()]


def _plain(rows):
    """(doc_id, text, ids) that the five stages leave, by SQL, all pairs and the library."""
    import sentencepiece

    kept = {r["doc_id"] for r in _sql(quality_rules.SQL, rows) if r["kept"]}
    rows = [r for r in rows if r[0] in kept]
    body = line_dedup.SQL.replace("sha256(kept) as kept_sha256", "kept")
    left = {r["doc_id"]: r["kept"] for r in _sql(body, rows)}
    rows = [(i, left[i], s) for i, _, s in rows]

    def items(t):
        w = t.encode().lower().split()
        return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)

    sets, parent = {i: items(t) for i, t, _ in rows}, {i: i for i, *_ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    rows = [r for r in rows if root(r[0]) == r[0]]
    copies = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in _sql(mixing.SQL, rows)}
    model = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())
    return sorted((i, t, model.encode(t)) for i, t, _ in rows for _ in range(copies[i]))


def test_pipeline_equals_the_plain_stages(spark, sf):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in source.collect()]
    out = corpus_pipeline.run(spark, sf)
    assert set(out.columns) == {*source.columns, "ids"}
    got = sorted((r.doc_id, r.text, r.ids) for r in out.collect())
    assert len(got) > 50 and got == _plain(rows)


def test_stages_on_odd_rows(spark, make_docs, odd_rows):
    for rows in (odd_rows, []):
        docs = make_docs(rows)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            if name != "sentence_pieces":
                assert out.columns == docs.columns, name
            docs = staged(out, name)


def test_stage_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "mixing", "sentence_pieces",
    ]
