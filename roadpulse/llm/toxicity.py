"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn whatever their label are the
unlabelled ones. With p the share of toxic documents (the class prior, taken from the
labelled rows that may be learned from), the risk of a classifier is
``p * risk(positives as 1) + max(0, risk(unlabelled as 0) - p * risk(positives as 0))``;
where the second part falls below 0, training steps back from it. A text is the set of
its words among the FEATURES that tell positives from unlabelled best. BAGS linear
classifiers learn from all positives and a part each of the unlabelled; the score is
their mean probability.

Learned from, at most: POSITIVES and UNLABELLED documents, drawn by a hash of the id from
rows whose remainder by FOLDS is not 0. Document frequencies of the words of this sample
are counted in Spark; the driver gets the FEATURES and, per sampled document, which of
them it has. Every document is scored whole.

Defined cases. Null and empty texts have no words and get the classifiers' score of the
empty set. Null labels are left out; of several labels for one id the larger counts. A
null ``doc_id`` is never held out and never learned from. Without positives every score is
0. Repeated rows are scored each on its own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import remainder, sampled, staged, whole_text

FOLDS = 5
POSITIVES, UNLABELLED = 4_000, 16_000
FEATURES = 512
LEAST_DOCS = 5
BAGS = 3
STEPS, RATE, DECAY = 400, 0.05, 1e-4


def word_hashes() -> Column:
    """Hashes of the distinct lower-case words of ``text``."""
    found = F.regexp_extract_all(F.lower(whole_text(F.col("text"))), F.lit(r"\p{L}+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda w: F.xxhash64(w)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights (the last one is the bias) that minimise the non-negative risk."""

    def with_bias(x):
        return np.hstack([x.astype(np.float32), np.ones((len(x), 1), np.float32)])

    p, u = with_bias(positive), with_bias(unlabelled)
    w = np.zeros(p.shape[1])
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        w32 = w.astype(np.float32)  # one type: numpy would convert the matrices in each step
        z_p, z_u = p @ w32, u @ w32
        negative_part = _softplus(z_u).mean() - prior * _softplus(z_p).mean()
        # Gradients of the losses: as 1 sigmoid(z) - 1, as 0 sigmoid(z).
        grad_negative = u.T @ _sigmoid(z_u) / len(u) - prior * (p.T @ _sigmoid(z_p)) / len(p)
        if negative_part >= 0:
            grad = prior * (p.T @ (_sigmoid(z_p) - 1)) / len(p) + grad_negative
        else:
            grad = -grad_negative
        grad[:-1] += DECAY * w[:-1]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad**2
        w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


@dataclass
class Model:
    """``words`` sorted hashes, ``weights`` a row per classifier with the bias last."""

    words: np.ndarray
    weights: np.ndarray

    def score(self, lists: pa.Array) -> np.ndarray:
        """Mean probability for each list of distinct hashes."""
        counts = np.diff(lists.offsets.to_numpy())
        of = np.repeat(np.arange(len(lists)), counts)
        z = np.tile(self.weights[:, -1], (len(lists), 1))
        if len(self.words):
            hashes = lists.flatten().to_numpy()
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            hit = self.words[at] == hashes
            for k, w in enumerate(self.weights):
                z[:, k] += np.bincount(of[hit], w[at[hit]], len(lists))
        return _sigmoid(z).mean(1) if len(self.weights) else np.zeros(len(lists))


def _present(lists, words: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lists), len(words)), np.uint8)
    for i, hashes in enumerate(lists):
        at = np.searchsorted(words, hashes)
        out[i, at] = 1
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows that may be learned from."""
    learn = F.col("doc_id").isNotNull() & (remainder(FOLDS) != 0)
    known = (
        labels.where(learn & F.col("toxic").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    prior = known.agg(F.avg("toxic")).first()[0] or 0.0
    present = docs.where(learn).select("doc_id").distinct()
    toxic = known.where("toxic = 1").select("doc_id").join(present, "doc_id", "left_semi")
    sides = sampled(toxic, POSITIVES, 11).withColumn("positive", F.lit(True)).union(
        sampled(present, UNLABELLED, 12).withColumn("positive", F.lit(False))
    )
    # At most POSITIVES + UNLABELLED ids, so they may be broadcast. Of an id's rows one is learned
    # from, the one with the smallest hash of its text: as many rows as ids reach the driver.
    one_row = F.min_by(F.struct("text"), F.xxhash64("text"))
    sample = staged(
        docs.select("doc_id", "text").join(F.broadcast(sides), "doc_id")
        .groupBy("doc_id", "positive").agg(one_row.alias("row")).select("doc_id", "positive", "row.text")
        .select("doc_id", "positive", word_hashes().alias("words")),
        "sample",
    )
    n_p, n_u = sample.agg(
        F.count(F.when(F.col("positive"), 1)), F.count(F.when(~F.col("positive"), 1))
    ).first()
    if not n_p or not 0 < prior < 1:
        return Model(np.zeros(0, np.int64), np.zeros((0, 1)))
    counts = sample.select("positive", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.when(F.col("positive"), 1)).alias("p"), F.count(F.when(~F.col("positive"), 1)).alias("u")
    )
    share_p, share_u = (F.col("p") + 0.5) / (n_p + 1), (F.col("u") + 0.5) / (n_u + 1)
    spread = share_p * (1 - share_p) / n_p + share_u * (1 - share_u) / n_u
    best = (
        counts.where(F.col("p") + F.col("u") >= LEAST_DOCS)
        .orderBy(F.desc(F.abs(share_p - share_u) / F.sqrt(spread)), "word").limit(FEATURES)
    )
    words = np.sort(np.array([r["word"] for r in best.collect()], np.int64))
    chosen = F.array(*(F.lit(int(w)) for w in words)).cast("array<bigint>")
    rows = sample.select("positive", F.array_intersect("words", chosen).alias("has")).orderBy(
        F.xxhash64("doc_id")
    ).toArrow()
    is_p = rows["positive"].to_numpy()
    x = _present(rows["has"].to_pylist(), words)
    bags = [train(x[is_p], part, prior) for part in np.array_split(x[~is_p], BAGS) if len(part)]
    return Model(words, np.array(bags))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.score(batch["words"]))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], score], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_hashes().alias("words"))
    return rows.mapInArrow(run, "doc_id long, score double")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select(
        "doc_id", F.coalesce(remainder(FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
