"""Approximate nearest neighbours: a forest of random-projection trees, then exact ranking.

TREES trees are fitted on at most SAMPLE vectors, drawn by a hash of the id: a node
projects on the line between two random groups (two random vectors, drawn apart by a few
means) and splits at the median. Every vector of the table is then put into a leaf of each
tree. A query searches all trees through one priority queue, whose entries are nodes with
the squared distances to the planes crossed so far; it takes the leaf that comes first
until the leaves taken hold SHARE of all rows (a row in two leaves counts twice).

Leaves are shuffled, not gathered: a task holds up to QUERIES queries of one leaf while the
leaf's vectors stream past, keeps the best of each query by exact distance, and the best of
all leaves are ranked in the end. The driver holds the sample, the forest and the number
of rows per leaf, all of fixed size.

SHARE and TREES were chosen for a recall of 0.97 on vectors without any structure, where
few rows can be ruled out; a table with clusters needs a smaller share.

Defined cases. Vectors that are null, empty, all zero, or hold a null or non-finite
component take no part, nor do those of another length than most (the shorter one of
equally frequent lengths), nor rows with a null ``vec_id``. Rows of one ``vec_id`` are one
thing in several places: its smallest distance counts, and it is no neighbour of itself.
Ties go to the smaller ``vec_id``. With fewer candidates than asked for, all are returned.
Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import sampled, staged

TREES, DEPTH = 8, 8
SAMPLE = 32_768
LEAF_SAMPLE = 8
SHARE = 1.0
QUERIES = 2_048
NEAREST = 10


@dataclass
class Forest:
    """Complete binary trees: ``normals[tree, node]``, ``offsets[tree, node]``; children of node i
    are 2i + 1 (at or below the plane) and 2i + 2."""

    normals: np.ndarray
    offsets: np.ndarray
    depth: int

    @classmethod
    def fit(cls, sample: np.ndarray, seed: int = 17) -> Forest:
        depth = int(min(DEPTH, max(0, np.floor(np.log2(max(len(sample), 1) / LEAF_SAMPLE)))))
        nodes, random = 2**depth - 1, np.random.default_rng(seed)
        normals = np.zeros((TREES, nodes, sample.shape[1]))
        offsets = np.zeros((TREES, nodes))
        for tree in range(TREES):
            inside = {0: np.arange(len(sample))}
            for node in range(nodes):
                own = inside.pop(node)
                normal = cls._direction(sample[own], random)
                along = sample[own] @ normal
                offset = float(np.median(along)) if len(own) else 0.0
                normals[tree, node], offsets[tree, node] = normal, offset
                inside[2 * node + 1], inside[2 * node + 2] = own[along <= offset], own[along > offset]
        return cls(normals, offsets, depth)

    @staticmethod
    def _direction(points: np.ndarray, random: np.random.Generator) -> np.ndarray:
        """From one random group of the points to another; 0 if all points are equal."""
        if len(points) < 2:
            return np.zeros(points.shape[1])
        points = points[random.permutation(len(points))[:400]]
        a, b = points[0], points[1]
        for _ in range(4):
            first = points @ (a - b) > (a @ a - b @ b) / 2
            if first.all() or not first.any():
                break
            a, b = points[first].mean(0), points[~first].mean(0)
        length = np.linalg.norm(a - b)
        return (a - b) / length if length else np.zeros(points.shape[1])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        out = np.zeros((len(x), TREES), np.int32)
        for tree in range(TREES):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.normals[tree, node]) > self.offsets[tree, node]
                node = 2 * node + 1 + side
            out[:, tree] = node - (2**self.depth - 1)
        return out

    def search(self, x: np.ndarray, rows: np.ndarray, most: float) -> list[tuple[int, int]]:
        """The (tree, leaf) pairs for one query; ``rows[tree, leaf]`` counts the table's rows."""
        over = self.normals @ x - self.offsets  # above 0: beyond the plane
        queue, taken, got = [(0.0, tree, 0) for tree in range(TREES)], [], 0
        first_leaf = 2**self.depth - 1
        while queue and got < most:
            cost, tree, node = heapq.heappop(queue)
            if node >= first_leaf:
                leaf = node - first_leaf
                if rows[tree, leaf]:
                    taken.append((tree, leaf))
                    got += int(rows[tree, leaf])
                continue
            gap = over[tree, node]
            heapq.heappush(queue, (cost + max(gap, 0.0) ** 2, tree, 2 * node + 1))
            heapq.heappush(queue, (cost + min(gap, 0.0) ** 2, tree, 2 * node + 2))
        return taken


def _usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy().astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def _with_leaves(rows: DataFrame, forest: Forest) -> DataFrame:
    kind = rows.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = forest.leaves(_matrix(batch["vector"]))
            lists = pa.FixedSizeListArray.from_arrays(leaves.ravel(), TREES).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["vec_id", "vector", "leaves"])

    return rows.mapInArrow(run, f"vec_id long, vector {kind}, leaves array<int>")


def _probes(queries: DataFrame, forest: Forest, rows: np.ndarray, most: float) -> DataFrame:
    kind = queries.schema["vector"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forest.search(x, rows, most) for x in _matrix(batch["vector"])]
            at = np.repeat(np.arange(len(found)), [len(f) for f in found])
            pairs = np.array([p for f in found for p in f], np.int32).reshape(-1, 2)
            taken = batch.take(pa.array(at))
            columns = [taken["vec_id"], taken["vector"], pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "tree", "leaf"])

    return queries.mapInArrow(run, f"vec_id long, vector {kind}, tree int, leaf int")


class _Leaf:
    """Some queries of a leaf and the nearest found so far for each."""

    def __init__(self, nearest: int):
        self.nearest, self.ids, self.parts = nearest, [], []
        self.best: list[list[tuple[float, int]]] = []

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids += ids.tolist()
        self.parts.append(x)
        self.best += [[] for _ in ids]

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Shortlist by a matrix product, rank the shortlist by exact distances."""
        q = self.parts[0] if len(self.parts) == 1 else np.concatenate(self.parts)
        self.parts = [q]
        own = np.einsum("ij,ij->i", x, x)
        rough = np.einsum("ij,ij->i", q, q)[:, None] + own - 2 * q @ x.T
        slack = 1e-9 * (1 + own.max() + np.abs(rough).max())
        rough[np.array(self.ids)[:, None] == ids] = np.inf
        first = min(self.nearest, len(x))
        bound = np.partition(rough, first - 1, axis=1)[:, first - 1]
        for i, best in enumerate(self.best):
            full = best[-1][0] ** 2 if len(best) == self.nearest else np.inf
            limit, take = bound[i], first
            while True:  # wider where rows of one id crowd the shortlist
                near = np.flatnonzero((rough[i] <= min(limit, full) + slack) & np.isfinite(rough[i]))
                if take == len(x) or limit >= full or len(np.unique(ids[near])) >= self.nearest:
                    break
                take = min(4 * take, len(x))
                limit = np.partition(rough[i], take - 1)[take - 1]
            exact = np.sqrt(((x[near] - q[i]) ** 2).sum(1))
            merged: dict[int, float] = {v: d for d, v in best}
            for v, d in zip(ids[near].tolist(), exact.tolist()):
                merged[v] = min(d, merged.get(v, np.inf))
            self.best[i] = heapq.nsmallest(self.nearest, ((d, v) for v, d in merged.items()))

    def results(self) -> Iterator[tuple[int, int, float]]:
        for query, best in zip(self.ids, self.best):
            yield from ((query, v, d) for d, v in best)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _ranker(nearest: int):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _FOUND)]
        return pa.RecordBatch.from_arrays(columns, schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (tree, leaf, block, kind): queries (kind 0), then vectors (kind 1)."""
        current, leaf = None, _Leaf(nearest)
        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("tree", "leaf", "block", "kind")])
            ends = np.flatnonzero(np.any(np.diff(keys, axis=1) != 0, axis=0)) + 1
            for low, high in zip([0, *ends], [*ends, batch.num_rows]):
                if low == high:
                    continue
                if (head := tuple(keys[:3, low])) != current:
                    if rows := list(leaf.results()):
                        yield batch_of(rows)
                    current, leaf = head, _Leaf(nearest)
                part = batch.slice(low, high - low)
                ids, x = part["vec_id"].to_numpy(), _matrix(part["vector"])
                if keys[3, low] == 0:
                    leaf.add(ids, x)
                elif leaf.ids:
                    for at in range(0, len(ids), 4096):
                        leaf.meet(ids[at : at + 4096], x[at : at + 4096])
        if rows := list(leaf.results()):
            yield batch_of(rows)

    return run


def nearest(
    table: DataFrame, is_query: Column, k: int = NEAREST, share: float = SHARE, vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row that is a query."""
    spark = table.sparkSession
    rows = table.where(F.col("vec_id").isNotNull() & _usable(F.col(vector))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector")
    )
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == common["d"])
    sample = sampled(rows, SAMPLE, 3, "vec_id").toArrow()
    forest = Forest.fit(_matrix(sample["vector"].combine_chunks()))
    index = staged(_with_leaves(rows, forest), "index")
    places = index.select("vec_id", "vector", F.posexplode("leaves").alias("tree", "leaf"))
    counts = np.zeros((TREES, 2**forest.depth), np.int64)
    for r in places.groupBy("tree", "leaf").count().collect():  # TREES * 2 ** DEPTH rows at most
        counts[r["tree"], r["leaf"]] = r["count"]
    queries = index.where(is_query).select("vec_id", "vector")
    n_queries = queries.count()
    blocks = max(1, -(-n_queries // QUERIES))
    probes = _probes(queries, forest, counts, share * common["n"])
    asked = probes.select(
        "tree", "leaf", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(0).alias("kind"), "vec_id", "vector",
    )
    stream = asked.union(
        places.select(
            "tree", "leaf", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
            F.lit(1).alias("kind"), "vec_id", "vector",
        )
    )
    found = (
        stream.repartition("tree", "leaf", "block")
        .sortWithinPartitions("tree", "leaf", "block", "kind")
        .mapInArrow(_ranker(k), "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op4_projection_forest(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(table, F.col("vec_id") % 100 == 0)
