"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated.

Words fall into BUCKETS by hash. Each bucket has an index vector of SPARSE random signs
among DIMENSIONS; its word vector is the mean of the index vectors of the words that stand
up to REACH places away, over the whole corpus, less the corpus mean, at unit length. Every
task adds up its own table and only its non-zero rows are shuffled. A document is the mean
and the deviation of its word vectors.

A network of two layers learns from at most LABELLED documents, drawn by a hash of the id
from rows whose remainder by FOLDS is not HELD; a part of them is kept back to choose the
temperature that divides the network's output before it becomes a probability. What the
driver holds is bounded: the table of BUCKETS rows and the pooled LABELLED documents.

Defined cases. Null and empty texts have no words; their pooled vector is 0. Null labels
are left out; of several labels for one id the smaller counts. A null ``doc_id`` is never
held out and never learned from. Without labels of both kinds every score is the mean
label, 0.5 if there is none. Repeated rows are scored each on its own. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import remainder, sampled, staged, whole_text

FOLDS, HELD = 4, 2
LABELLED = 20_000
BUCKETS, DIMENSIONS, SPARSE, REACH = 32_768, 32, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 0.003, 1e-4
LETTERS_OR_SIGN = r"\p{L}+|[^\s\p{L}]"


def _index_table() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the index vector of each bucket."""
    random = np.random.default_rng(7)
    return random.integers(0, DIMENSIONS, (BUCKETS, SPARSE)), random.choice([-1.0, 1.0], (BUCKETS, SPARSE))


def buckets() -> Column:
    """The bucket of each word or sign of ``text``, in order."""
    found = F.regexp_extract_all(whole_text(F.col("text")), F.lit(LETTERS_OR_SIGN), F.lit(0))
    return F.transform(found, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values, and the number of the list that each is in."""
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))


def _add_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums: per bucket its neighbours' index vectors and their number."""
    place, sign = _index_table()
    table = np.zeros((BUCKETS, DIMENSIONS + 1))
    for batch in batches:
        bucket, doc = _flat(batch["buckets"])
        for step in range(1, REACH + 1):
            same = doc[step:] == doc[:-step]
            left, right = bucket[:-step][same], bucket[step:][same]
            for own, other in ((left, right), (right, left)):
                at = own.astype(np.int64) * (DIMENSIONS + 1)
                for k in range(SPARSE):
                    table += np.bincount(at + place[other, k], sign[other, k], table.size).reshape(table.shape)
                table[:, -1] += np.bincount(own, minlength=BUCKETS)
    some = np.flatnonzero(table[:, -1])
    if len(some):
        sums = pa.FixedSizeListArray.from_arrays(table[some].ravel(), DIMENSIONS + 1).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), sums], ["bucket", "sums"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of word vectors, BUCKETS rows, of the whole corpus."""
    parts = docs.select(buckets().alias("buckets")).mapInArrow(_add_neighbours, "bucket int, sums array<double>")
    sums = parts.groupBy("bucket").agg(
        F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(DIMENSIONS + 1))).alias("sums")
    )
    rows = sums.toArrow()
    table = np.zeros((BUCKETS, DIMENSIONS + 1))
    if rows.num_rows:
        table[rows["bucket"].to_numpy()] = np.array(rows["sums"].to_pylist())
    count = table[:, -1:]
    total = max(count.sum(), 1)
    vectors = np.where(count > 0, table[:, :-1] / np.maximum(count, 1) - table[:, :-1].sum(0) / total, 0)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-12)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, pooled): mean and deviation of the word vectors of each document."""
    table = docs.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS rows, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch["buckets"]
            flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            for low, high in zip(offsets[:-1], offsets[1:]):
                words = table.value[flat[low:high]] if high > low else np.zeros((1, DIMENSIONS), np.float32)
                out.append(np.r_[words.mean(0), words.std(0)].astype(np.float32))
            values = np.concatenate(out) if out else np.zeros(0, np.float32)
            lists = pa.FixedSizeListArray.from_arrays(values, 2 * DIMENSIONS).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], ["doc_id", "pooled"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), buckets().alias("buckets"))
    return rows.mapInArrow(run, "doc_id long, pooled array<float>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass
class Network:
    """Scaling of the input, two layers, temperature; ``constant`` replaces all of it."""

    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: list | None = None
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x) / self.temperature)


def train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Network:
    """A network for the labels; a fifth of the rows chooses its temperature."""
    if not 0 < y.sum() < len(y):
        return Network(constant=float(y.mean()) if len(y) else 0.5)
    random = np.random.default_rng(seed)
    order = random.permutation(len(x))
    cut = len(x) // 5
    kept_back, learn = order[:cut], order[cut:]
    mean, scale = x[learn].mean(0), x[learn].std(0) + 1e-6
    net = Network(mean, scale, [
        random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(()),
    ])
    z = (x - mean) / scale
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    step = 0
    for _ in range(EPOCHS):
        for at in np.array_split(random.permutation(learn), max(1, len(learn) // BATCH)):
            step += 1
            w1, b1, w2, b2 = net.weights
            hidden = np.tanh(z[at] @ w1 + b1)
            error = (_sigmoid(hidden @ w2 + b2) - y[at]) / len(at)
            back = np.outer(error, w2) * (1 - hidden**2)
            grads = [z[at].T @ back + DECAY * w1, back.sum(0), hidden.T @ error + DECAY * w2, error.sum()]
            for i, g in enumerate(grads):
                m = 0.9 * moments[i][0] + 0.1 * g
                v = 0.999 * moments[i][1] + 0.001 * g**2
                moments[i] = (m, v)
                fixed = m / (1 - 0.9**step)
                net.weights[i] = net.weights[i] - RATE * fixed / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    if cut:
        out, truth = net.logits(x[kept_back]), y[kept_back]
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 101))
        loss = [np.mean(np.logaddexp(0, out / t) - truth * out / t) for t in choices]
        net.temperature = float(choices[int(np.argmin(loss))])
    return net


def fit(features: DataFrame, labels: DataFrame) -> Network:
    """Learn from the pooled documents that may be learned from."""
    learn = F.col("doc_id").isNotNull() & (remainder(FOLDS) != HELD)
    known = (
        labels.where(learn & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    )
    rows = sampled(features.join(known, "doc_id"), LABELLED, 21).toArrow()
    if not rows.num_rows:
        return Network(constant=0.5)
    x = np.array(rows["pooled"].combine_chunks().flatten()).reshape(rows.num_rows, -1).astype(float)
    return train(x, rows["quality"].to_numpy().astype(float))


def scored(features: DataFrame, network: Network) -> DataFrame:
    """(doc_id, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch["pooled"].flatten().to_numpy().reshape(batch.num_rows, 2 * DIMENSIONS).astype(float)
            score = pa.array(network.probability(x))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], score], ["doc_id", "score"])

    return features.mapInArrow(run, "doc_id long, score double")


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    features = staged(pooled(docs, word_vectors(docs)), "pooled")
    network = fit(features, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(features, network).select(
        "doc_id", F.coalesce(remainder(FOLDS) == HELD, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )
