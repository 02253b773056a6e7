"""Approximate nearest neighbours with a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample (`SAMPLED` vectors, chosen by a hash of the id; equal ones count
once): each node's vectors are split into `BRANCHES` clusters until a leaf would hold about `LEAF` rows of
the table. Every row of the table is put into the leaf it falls to.

A search goes from bin to bin through a priority queue of the distance to their centres. How many leaves it
visits is calibrated: exact neighbours of `CALIBRATED` sampled rows are found against the whole table, and
the number of leaves is doubled until the leaves visited hold `RECALL` of them. A search also goes on while
its leaves hold fewer rows than are wanted. Leaves beside each other are searched by one task, up to `PART` rows;
a leaf with more is split by a hash of the id, and a query visits each part. Distances are Euclidean, in double precision, on the vectors as given.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do rows without an id. Rows that repeat an id are candidates of their own; of repeated queries the
one with the least vector is searched for. A query's own id is no neighbour. Ties go to the smaller id. An
empty table gives an empty one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsync.llm.batches import ship_code
from fieldsync.sources.staging import stage

#: Vectors sampled at most, about; rows of a leaf, about; clusters of a node; rounds of k-means.
SAMPLED, LEAF, BRANCHES, ROUNDS = 40_000, 400, 8, 8
#: Sampled vectors a leaf needs: so a table of any size has SAMPLED / SAMPLED_LEAF leaves at most.
SAMPLED_LEAF = 10
#: Queries the number of leaves is calibrated on, and the recall they must reach.
CALIBRATED, RECALL = 100, 0.95
#: Rows that a task searches, about.
PART = 20_000


@dataclass
class Tree:
    """Centres of the nodes, their first child and number of children (0: a leaf), and the number of each leaf."""

    centres: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf each vector falls to."""
        nodes = np.zeros(len(vectors), np.int64)
        while len(inner := np.flatnonzero(self.children[nodes])):
            for node in np.unique(nodes[inner]):
                rows = inner[nodes[inner] == node]
                a = self.first[node]
                nodes[rows] = a + squared(vectors[rows], self.centres[a : a + self.children[node]]).argmin(axis=1)
        return self.leaf[nodes]

    def visited(self, vector: np.ndarray) -> Iterator[int]:
        """Leaves, the best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            n, a = self.children[node], self.first[node]
            if not n:
                yield int(self.leaf[node])
                continue
            for i, d in enumerate(squared(vector[None], self.centres[a : a + n])[0].tolist()):
                heapq.heappush(queue, (d, int(a + i)))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0)


def clustered(vectors: np.ndarray, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the cluster of each vector, none empty."""
    centres = vectors[random.choice(len(vectors), min(BRANCHES, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        of = squared(vectors, centres).argmin(axis=1)
        used, of = np.unique(of, return_inverse=True)
        sums = np.zeros((len(used), vectors.shape[1]))
        np.add.at(sums, of, vectors)
        centres = sums / np.bincount(of)[:, None]
    of = squared(vectors, centres).argmin(axis=1)
    used, of = np.unique(of, return_inverse=True)
    return centres[used], of


def fitted(sample: np.ndarray, most: int) -> Tree:
    """A tree whose leaves hold `most` sampled vectors or fewer."""
    random = np.random.default_rng(3)
    centres, first, children = [sample.mean(axis=0)], [0], [0]
    todo = [(0, sample)]
    while todo:
        node, rows = todo.pop()
        if len(rows) <= most:
            continue
        own, of = clustered(rows, random)
        if len(own) < 2:
            continue
        first[node], children[node] = len(centres), len(own)
        for i, centre in enumerate(own):
            todo.append((len(centres), rows[of == i]))
            centres.append(centre)
            first.append(0)
            children.append(0)
    children_, leaf = np.array(children), np.full(len(children), -1)
    leaf[children_ == 0] = np.arange((children_ == 0).sum())
    return Tree(np.array(centres), np.array(first), children_, leaf)


def usable(vector: Column, length: int) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) == length) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(array: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column, in double precision."""
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(array), -1) if len(array) else np.empty((0, 0))


def nearest(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the k nearest, ties to the smaller id, without the query's own id."""
    d = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    d[ids == own] = np.inf
    if len(d) > k:
        near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
    else:
        near = np.arange(len(d))
    near = near[np.isfinite(d[near])]
    near = near[np.lexsort((ids[near], d[near]))][:k]
    return near, d[near]


def best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query among what its tasks have found."""
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def neighbours(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (distance) of each query's k nearest."""
    spark = vectors.sparkSession
    ship_code(spark)
    schema = "query_id long, rank int, vec_id long, score double"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"), is_query.alias("is_query")).where(F.col("vec_id").isNotNull())
    common = rows.where(F.size("vector") > 0).groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if common is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(usable(F.col("vector"), common["length"]))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)
    place = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(1 << 30))
    sampled = rows.select("vec_id", "vector", place.alias("place")).where(F.col("place") < max(1, int((1 << 30) * min(1.0, SAMPLED / n))))
    sample = sampled.limit(2 * SAMPLED).toArrow() if n > SAMPLED else rows.select("vec_id", "vector").toArrow()
    chosen = matrix(sample.column("vector").combine_chunks()) if sample.num_rows else np.zeros((1, common["length"]))
    ids = sample.column("vec_id").to_numpy()
    unique, at = np.unique(chosen, axis=0, return_index=True)
    tree = fitted(unique, max(SAMPLED_LEAF, int(LEAF * len(unique) / n)))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaves_of(matrix(batch.column(1))) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=["vec_id", "vector", "is_query", "leaf"])

    kind = dict(rows.dtypes)["vector"]
    placed = stage(rows.mapInArrow(leaves, f"vec_id long, vector {kind}, is_query boolean, leaf int"), "kmeans-leaves")
    sizes = np.zeros(int(tree.leaf.max()) + 1, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # one row per leaf at most
        sizes[row["leaf"]] = row["count"]
    random = np.random.default_rng(4)
    probes = at[random.choice(len(at), min(CALIBRATED, len(at)), replace=False)]
    visits = calibrated(placed, tree, ids[probes], chosen[probes], k)
    group, parts = grouped(sizes)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with the group of their leaf and their part of it."""
        for batch in batches:
            leaf, ids_ = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.uint64)
            part = (ids_ * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[leaf]
            yield pa.RecordBatch.from_arrays([pa.array(group[leaf], pa.int32()), pa.array(part, pa.int32()), *batch.columns], names=["group", "part", "leaf", "vec_id", "vector"])

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the leaves they visit, once per group and part."""
        for batch in batches:
            vectors_ = matrix(batch.column(1)) if batch.num_rows else []
            row, to, part, leaves_ = [], [], [], []
            for i, vector in enumerate(vectors_):
                held, seen = 0, {}
                for n_seen, x in enumerate(tree.visited(vector)):
                    if n_seen >= visits and held > k:
                        break
                    held += sizes[x]
                    seen.setdefault(int(group[x]), []).append(x)
                for g, xs in seen.items():
                    for p in range(parts[xs[0]]):
                        row.append(i)
                        to.append(g)
                        part.append(p)
                        leaves_.append(xs)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(to, pa.int32()), pa.array(part, pa.int32()), pa.array(leaves_, pa.list_(pa.int32()))], names=["query_id", "query", "group", "part", "leaves"]
            )

    members = placed.select("leaf", "vec_id", "vector").mapInArrow(dealt, f"group int, part int, leaf int, vec_id long, vector {kind}")
    queries = placed.where("is_query").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("query"))
    sent = queries.mapInArrow(routes, f"query_id long, query {kind}, group int, part int, leaves array<int>")

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = []
        if asked.num_rows and held.num_rows:
            held = held.sort_by("leaf")
            vectors_, ids_, leaf = matrix(held.column("vector").combine_chunks()), held.column("vec_id").to_numpy(), held.column("leaf").to_numpy()
            queries_ = matrix(asked.column("query").combine_chunks())
            for query_id, query, visited in zip(asked.column("query_id").to_pylist(), queries_, asked.column("leaves").to_pylist(), strict=True):
                rows_ = np.concatenate([np.arange(*np.searchsorted(leaf, (x, x + 1))) for x in visited])
                near, d = nearest(vectors_[rows_], ids_[rows_], query, query_id, k)
                found.append((np.full(len(near), query_id), ids_[rows_][near], d))
        q, v, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else ([], [], [])
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    pairs = sent.groupBy("group", "part").cogroup(members.groupBy("group", "part")).applyInArrow(search, "query_id long, vec_id long, score double")
    return best(pairs, k).select("query_id", "rank", "vec_id", "score")


def grouped(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each leaf, and the number of parts its group is split into: neighbours up to `PART` rows, or one large leaf."""
    group, parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // PART))
    now = rows = 0
    for leaf, n in enumerate(sizes.tolist()):
        if rows and rows + n > PART:
            now, rows = now + 1, 0
        group[leaf] = now
        rows += n
    return group, parts


def calibrated(placed: DataFrame, tree: Tree, ids: np.ndarray, probes: np.ndarray, k: int) -> int:
    """Leaves to visit so that the probes' exact neighbours in the whole table are found."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, own = matrix(batch.column(1)), batch.column(0).to_numpy()
            for query_id, query in zip(ids.tolist(), probes, strict=True):
                near, d = nearest(vectors, own, query, query_id, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(near), query_id), pa.int64()), pa.array(own[near], pa.int64()), pa.array(d, pa.float64()), batch.column(2).take(pa.array(near))],
                    names=["query_id", "vec_id", "score", "leaf"],
                )

    found = placed.select("vec_id", "vector", "leaf").mapInArrow(exact, "query_id long, vec_id long, score double, leaf int")
    wanted: dict[int, list[int]] = {}
    for row in best(found, k).collect():  # CALIBRATED * k rows at most
        wanted.setdefault(row["query_id"], []).append(row["leaf"])
    places = []
    for query_id, probe in zip(ids.tolist(), probes, strict=True):
        order = {leaf: i for i, leaf in enumerate(tree.visited(probe))}
        places += [order[leaf] for leaf in wanted.get(query_id, [])]
    visits = 1
    while places and np.mean(np.array(places) < visits) < RECALL:
        visits *= 2
    return visits
