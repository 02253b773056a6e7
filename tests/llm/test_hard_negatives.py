"""Hard negatives against plain scores of all pairs."""

import math

import numpy as np
import pytest

from fieldsync.llm import hard_negatives as hn
from fieldsync.llm.catalog import op12_hard_negatives

DIRECTORY = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, block int, ids string, rank int"


def plain(rows):
    """Of (vec_id, vector, label): the contract, pair by pair."""
    held = {}
    for i, vector, label in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2] is None, r[2] or 0, r[1] or [])):
        if i is None or vector is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.setdefault(i, (label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    made = []
    for a, (label, vector) in held.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(vector, v, strict=True)), i, lab) for i, (lab, v) in held.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == label][: hn.POSITIVES]:
            fit = [(i, -ns) for ns, i, lab in scored if lab != label and 30 * -ps <= 100 * -ns <= 90 * -ps]
            made += [(a, p, rank, i, -ps, ns) for rank, (i, ns) in enumerate(fit[: hn.NEGATIVES], 1)]
    return sorted(made)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def mined(spark, rows):
    from pyspark.sql import functions as F

    return sorted(tuple(r) for r in hn.mined(table(spark, rows), F.col("vec_id") % 100 == 0).collect())


def clustered(n, length, seed=0):
    random = np.random.default_rng(seed)
    centres = random.standard_normal((12, length))
    rows = centres[random.integers(0, 12, n)] + 0.7 * random.standard_normal((n, length))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    return [(i, [float(x) for x in v.astype(np.float32)], int(random.integers(0, 4))) for i, v in enumerate(rows)]


@pytest.mark.parametrize("length", [3, 64, 100])
def test_intervals_hold(length):
    random = np.random.default_rng(length)
    vectors = np.concatenate([random.integers(-200, 200, (400, length)), np.zeros((2, length), np.int64), np.full((2, length), 7)])
    codes, (words, turns) = hn.Codes(vectors), hn.rotations(length)
    half = []
    for vector in (*vectors[:5], vectors[400], vectors[402]):
        query, rows = hn.Query(vector, words, turns), np.arange(len(vectors))
        so_far, off = np.zeros(len(rows)), np.zeros(len(rows))
        for s in range(hn.STAGES):
            so_far, off, now = query.intervals(codes, rows, so_far, off, s)
            assert (np.abs(so_far - vectors @ vector) <= now).all()
        half.append(now.mean() / (query.size * codes.size.mean() + 1))
    assert np.mean(half) < 0.1


def test_codes_filter():
    rows = np.array([r[1] for r in clustered(6000, 64)])
    vectors = np.floor(256 * rows).astype(np.int64)
    codes, (words, turns) = hn.Codes(vectors), hn.rotations(64)
    left = [len(hn.survivors(hn.Query(v, words, turns), codes, np.arange(6000), hn.best_of(5))) for v in vectors[:20]]
    assert np.mean(left) < 0.1 * 6000


@pytest.mark.parametrize("limits", [{}, {"ROWS": 40, "ANCHORS": 2, "MERGED": 3}])
def test_against_all_pairs(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(hn, name, value)
    rows = clustered(620, 64, 1)
    rows[100] = (100, rows[7][1], 0)
    rows[300] = (300, rows[7][1], 0)
    rows += [(1000 + i, rows[i % 9][1], i % 4) for i in range(200)]  # ties
    assert mined(spark, rows) == plain(rows) != []


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.5], 1), (1, [1.0, 0.1, 0.5], 1), (2, [0.5, 0.0, 0.2], 2), (3, [0.6, 0.0, 0.2], 2), (3, [0.6, 0.0, 0.2], 2), (3, [0.9, 0.9, 0.9], 3),
        (4, None, 1), (5, [1.0, None, 0.5], 1), (6, [nan, 0.0, 0.0], 2), (7, [inf, 0.0, 0.0], 2), (8, [1.0, 0.0, 0.5], None), (None, [1.0, 0.0, 0.5], 1),
        (9, [0.0, 0.0, 0.0], 2), (10, [-1.0, 0.0, -0.5], 1), (100, [0.0, 0.0, 0.0], 1), (200, [-1.0, 0.0, 0.3], 5), (300, [0.001, -0.002, 0.0], 1),
    ]
    assert mined(spark, rows) == plain(rows) != []
    assert mined(spark, [*rows, (11, [1.0, 2.0], 1), (12, [], 1), (13, [3e38, 0.0, 0.0], 2)]) == plain(rows)
    assert mined(spark, []) == [] and mined(spark, rows[1:4]) == [] and mined(spark, rows[:1]) == []


def test_query(spark):
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{DIRECTORY}/embeddings.parquet").collect()]
    made = sorted(tuple(r) for r in op12_hard_negatives(spark, DIRECTORY).collect())
    assert made == plain(rows) != []
