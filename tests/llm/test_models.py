"""Classifiers by held-out accuracy, nearest neighbours by recall, and their odd inputs."""

import math

import numpy as np
import pytest

from roadpulse.llm import projection_forest, quality_classifier, toxicity
from roadpulse.llm.common import sampled

MIDDLE = "/root/testdata/sf0.1"


def _held_out(spark, result, label):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = result.join(labels, "doc_id").where("held_out").select("score", "predicted", label).toPandas()
    return rows["score"].to_numpy(), rows["predicted"].to_numpy(), rows[label].to_numpy()


def _area(score, truth):
    order = score.argsort(kind="stable").argsort() + 1
    ones = truth.sum()
    return (order[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))


def test_toxicity_on_held_out_rows(spark, sf):
    score, predicted, truth = _held_out(spark, toxicity.op3_toxicity(spark, MIDDLE), "toxic")
    assert _area(score, truth) > 0.95 and (predicted == truth).mean() > 0.95
    assert ((predicted == 1) & (truth == 0)).sum() <= 0.01 * (truth == 0).sum()


def test_quality_on_held_out_rows(spark, sf):
    score, predicted, truth = _held_out(
        spark, quality_classifier.op10_quality_classifier(spark, MIDDLE), "quality"
    )
    assert _area(score, truth) > 0.97 and (predicted == truth).mean() > 0.95


@pytest.fixture
def few_labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, extra string")

    return make


def test_toxicity_of_odd_rows(make_docs, few_labels, odd_rows):
    docs = make_docs(odd_rows)
    model = toxicity.fit(docs, few_labels([]))
    assert {r.score for r in toxicity.scored(docs, model).collect()} == {0.0}
    texts = [(i, "plain words and an insult" if i % 3 == 0 else "plain words only") for i in range(200)]
    labels = [(i, None, int(i % 3 == 0), "x") for i in range(200)] + [(5, None, None, None), (5, 1, 0, "")]
    more = make_docs(odd_rows + texts)
    model = toxicity.fit(more, few_labels(labels))
    out = toxicity.scored(more, model).collect()
    assert len(out) == len(odd_rows) + 200 and all(0 <= r.score <= 1 for r in out)
    by_id = {r.doc_id: r.score for r in out if r.doc_id and r.doc_id >= 100}
    assert min(s for i, s in by_id.items() if i % 3 == 0) > max(s for i, s in by_id.items() if i % 3)
    assert toxicity.scored(make_docs([]), model).count() == 0


def test_risk_never_pays_for_negative_unlabelled_risk():
    """All positives are also unlabelled: without the bound the fit would run away."""
    x = np.eye(4, dtype=np.uint8)[np.arange(40) % 4]
    w = toxicity.train(x[x[:, 0] == 1], x, 0.25)
    p = 1 / (1 + np.exp(-(w[:-1] + w[-1])))
    assert p[0] > 0.5 > p[1:].max() and np.abs(w).max() < 50


def test_quality_of_odd_rows(make_docs, few_labels, odd_rows):
    docs = make_docs(odd_rows)
    features = quality_classifier.pooled(docs, quality_classifier.word_vectors(docs))
    network = quality_classifier.fit(features, few_labels([(1, None, 0, ""), (999, 1, 0, "")]))
    out = quality_classifier.scored(features, network).collect()
    assert len(out) == len(odd_rows) and {r.score for r in out} == {0.5}
    empty = make_docs([])
    vectors = quality_classifier.word_vectors(empty)
    assert not vectors.any()
    assert quality_classifier.scored(quality_classifier.pooled(empty, vectors), network).count() == 0


def test_labels_of_held_out_rows_do_not_matter(make_docs, few_labels):
    from pyspark.sql import functions as F

    texts = [(i, ("bad " if i % 4 == 0 else "fine ") * 8 + "words") for i in range(120)]
    docs = make_docs(texts)
    held = {
        n: {r.doc_id for r in docs.where(F.crc32(F.col("doc_id").cast("string")) % n == k).collect()}
        for n, k in ((5, 0), (4, 2))
    }
    scores = []
    for flip in (False, True):
        labels = few_labels([
            (i, int((i % 4 > 0) ^ (flip and i in held[4])), int((i % 4 == 0) ^ (flip and i in held[5])), "")
            for i in range(120)
        ])
        t = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
        features = quality_classifier.pooled(docs, quality_classifier.word_vectors(docs))
        q = quality_classifier.scored(features, quality_classifier.fit(features, labels)).collect()
        scores.append(sorted((r.doc_id, round(r.score, 9)) for r in t + q))
    assert scores[0] == scores[1]


# --- nearest neighbours


def _plain(ids, x, queries, k):
    out = {}
    for i in queries:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_against_brute_force(spark, sf):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{MIDDLE}/embeddings.parquet")
    ids, x = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), float)
    want = _plain(ids, x, np.flatnonzero(ids % 100 == 0), 10)
    got = {}
    for r in projection_forest.op4_projection_forest(spark, MIDDLE).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = 0
    for i, nearest in want.items():
        mine = sorted(got[i])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        hits += len({m[1] for m in mine} & {n[0] for n in nearest})
    assert hits >= 0.9 * 10 * len(want)


def test_odd_vectors_take_no_part(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [None, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (9, [1.0, -1.0]), (10, [5.0, 0.0]),
        (10, [3.0, 0.0]), (11, [3.0, 0.0]), (12, [1.0, 1.0]),
    ]
    table = spark.createDataFrame(
        [(i, v, 1, 2, 3, 4) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int, tree int, leaf int"
    )
    from pyspark.sql import functions as F

    out = projection_forest.nearest(table, F.col("vec_id") % 10 == 0, k=3).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 10)}
    assert got[0] == [(1, 1.0), (9, 1.0), (12, 1.0)]
    assert got[10] == [(11, 0.0), (0, 2.0), (1, math.sqrt(5))]


def test_few_and_equal_vectors(spark):
    from pyspark.sql import functions as F

    schema = "vec_id long, embedding array<double>"
    assert projection_forest.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    same = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(300)], schema)
    out = projection_forest.nearest(same, F.col("vec_id") == 100).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in out] == [(i, 0.0) for i in range(10)]
    two = spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)
    assert [tuple(r) for r in projection_forest.nearest(two, F.col("vec_id") == 1).collect()] == [(1, 1, 2, 1.0)]


def test_a_sample_has_its_size_however_often_an_id_is_repeated(spark):
    rows = spark.range(60_000).selectExpr("case when id < 59000 then 5 else id end as doc_id", "id as n")
    for seed in range(3):
        assert sampled(rows, 2_000, seed).count() == 2_000
    assert sampled(rows.where("doc_id = 5"), 100, 1).count() == 100
    assert sampled(rows, 70_000, 1).count() == 60_000
    plain = spark.range(30_000).selectExpr("id as doc_id")
    first, again = (sorted(r[0] for r in sampled(d, 500, 9).collect()) for d in (plain, plain.repartition(7)))
    assert first == again and len(first) == 500


def test_toxicity_learns_from_one_row_of_a_repeated_id(spark):
    docs = spark.range(400).selectExpr(
        "id as doc_id", "if(id % 2 = 0, 'vile awful words ' || id % 7, 'kind plain words ' || id % 5) as text"
    )
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) as toxic")
    repeated = docs.union(docs.where("doc_id = 2").crossJoin(spark.range(3_000)).select("doc_id", "text"))
    one, many = (toxicity.fit(d, labels) for d in (docs, repeated))
    assert (one.words == many.words).all() and abs(one.weights - many.weights).max() < 1e-3
