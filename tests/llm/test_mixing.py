"""Schedules keep every source within a block of its share."""

from collections import Counter
from fractions import Fraction

import pytest

from fieldsync.llm import mixing


def test_order_of_documents(spark, documents):
    rows = [(i, "x" * (50 + i % 7), "ab"[i % 5 == 0]) for i in range(400)]
    docs = documents(rows)
    weights = spark.createDataFrame([("a", 1), ("b", 1)], "source string, weight long")
    made = mixing.scheduled(docs, weights, block=200).collect()
    assert len(made) == 400 and made[0]["__extra"] == "x"
    order = sorted(made, key=lambda r: (r.mix.slot, r.mix.place, r.doc_id))
    size = Counter()
    for r in order[:100]:  # while neither has run out, both have had the same up to a block and a document
        size[r.source] += len(r.text)
        assert abs(size["a"] - size["b"]) <= 2 * (200 + 57)
    assert [r.doc_id for r in mixing.interleaved(docs, weights, block=200).collect()] == [r.doc_id for r in order]
    for source in "ab":  # no bytes are skipped or taken twice
        at = sorted((r.mix.block * 200 + r.mix.place, len(r.text)) for r in made if r.source == source)
        assert all(b + n == c for (b, n), (c, _) in zip(at, at[1:], strict=False)) and at[0][0] == 0


def test_ranges_add_up(spark, documents, monkeypatch):
    docs = documents([(i, "y" * (i % 30), "s") for i in range(300)])
    weights = mixing.tempered_weights(docs)
    whole = {r.doc_id: r.mix for r in mixing.scheduled(docs, weights, block=64).collect()}
    monkeypatch.setattr(mixing, "RANGE", 1)
    assert {r.doc_id: r.mix for r in mixing.scheduled(docs, weights, block=64).collect()} == whole


def test_odd_rows(documents, odd_rows):
    docs = documents([*((d, t, None) for d, t in odd_rows), (99, "with source", "s")])
    made = mixing.interleaved(docs, mixing.tempered_weights(docs))
    assert made.columns == docs.columns
    assert Counter(made.collect()) == Counter(docs.collect())
    empty = documents([])
    assert mixing.interleaved(empty, mixing.tempered_weights(empty)).collect() == []


@pytest.mark.parametrize("weights", [{"a": 190, **{f"s{i:02}": 20 for i in range(19)}}, {f"s{i:02}": 100_003 // (i + 1) for i in range(12)}, {"a": 10**9 + 7, "b": 1}])
def test_weights_as_given_over_many_slots(spark, weights):
    """Rounded to 1,000 slots, these drift by more than a block."""
    total, n = sum(weights.values()), 2_500
    blocks = {s: max(1, n * w // total) for s, w in weights.items()}
    sizes = spark.createDataFrame([(s, w, 8 * blocks[s]) for s, w in weights.items()], "source string, weight long, size long")
    made = sorted(mixing.placed(sizes, 8).collect(), key=lambda r: r.slot)
    following, t, plain = dict.fromkeys(weights, 0), 0, []
    while left := [s for s in weights if following[s] < blocks[s]]:
        t = max(t, min(following[s] * total // weights[s] for s in left))
        s = min((-(-(following[s] + 1) * total // weights[s]), s) for s in left if following[s] * total // weights[s] <= t)[1]
        plain.append((s, following[s], t))
        following[s], t = following[s] + 1, t + 1
    assert [(r.source, r.block, r.slot) for r in made] == plain
    had = Counter()
    for r in made:
        had[r.source] += 1
        for s, w in weights.items():
            if had[s] < blocks[s]:
                assert abs(had[s] - Fraction(w * (r.slot + 1), total)) < 1


def test_unlisted_sources_stay(spark, documents):
    docs = documents([(i, "x" * 9, "abc"[i % 3]) for i in range(60)] + [(90, "null", None)])
    weights = spark.createDataFrame([("a", 3), ("gone", 2), ("b", 0)], "source string, weight long")
    made = mixing.scheduled(docs, weights, block=10).collect()
    assert sorted(r.doc_id for r in made) == [*range(60), 90]
    total = 3 + 2 + 1 + 1 + 1
    assert all(r.mix.release == r.mix.block * total // (3 if r.source == "a" else 1) <= r.mix.slot < r.mix.deadline for r in made)
