"""Neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldsync.llm import kmeans_tree
from fieldsync.llm.catalog import op7_kmeans_tree


def exact(ids, vectors, query, own, k=10):
    d = np.sqrt(((vectors - query) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != own][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(x) for q, x in out.items()}


@pytest.mark.parametrize("leaf, part, k_means", [(400, 20_000, 8), (40, 9, 4)])
def test_recall(spark, monkeypatch, leaf, part, k_means):
    for name, value in (("LEAF", leaf), ("PART", part), ("BRANCHES", k_means)):
        monkeypatch.setattr(kmeans_tree, name, value)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    made = by_query(op7_kmeans_tree(spark, "/root/testdata/sf0.01").collect())
    assert sorted(made) == sorted(i for i in ids.tolist() if i % 100 == 0)
    hits = total = 0
    for q, found in made.items():
        expected = exact(ids, vectors, vectors[ids == q][0], q)
        assert [r for r, _, _ in found] == [*range(1, 11)]
        true = dict(exact(ids, vectors, vectors[ids == q][0], q, len(ids)))
        assert all(abs(true[v] - s) < 1e-12 for _, v, s in found)
        hits += len({v for _, v, _ in found} & {v for v, _ in expected})
        total += len(expected)
    assert hits / total >= 0.9


def test_searching_widens(monkeypatch):
    """A hard case: without structure the calibrated number of leaves grows until the recall is there."""
    random = np.random.default_rng(0)
    vectors = random.normal(size=(2_000, 16))
    tree = kmeans_tree.fitted(vectors, 20)
    leaves = tree.leaves_of(vectors)
    assert sorted(set(leaves.tolist())) == [*range(int(tree.leaf.max()) + 1)]
    order = [*tree.visited(vectors[0])]
    assert sorted(order) == sorted(set(leaves.tolist())) and order[0] == leaves[0]


def test_odd_vectors(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(30)]
    rows += [(100, None), (200, [0.0, 0.0]), (300, [float("nan"), 1.0]), (400, [1.0, None]), (500, [1.0]), (None, [1.0, 1.0]), (600, [float("inf"), 0.0]), (3, [0.0, 1.0]), (0, [0.0, 1.0])]
    made = by_query(kmeans_tree.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 100 == 0).collect())
    assert [(r, v, round(s, 9)) for r, v, s in made[0]] == [(i + 1, v, 0.0) for i, v in enumerate([3, 3, 6, 9, 12, 15, 18, 21, 24, 27])]
    assert set(made) == {0}
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert by_query(kmeans_tree.neighbours(few, F.col("vec_id") == 0).collect()) == {0: [(1, 1, 1.0), (2, 2, 1.0)]}
    for empty in ([], [(0, None)], [(0, [])], [(0, [0.0])]):
        assert kmeans_tree.neighbours(spark.createDataFrame(empty, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect() == []


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "PART", 50)
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(1000 + i, [float(i), -1.0]) for i in range(200)]
    made = by_query(kmeans_tree.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 200).collect())
    assert [v for _, v, _ in made[200]] == [*range(10)]
