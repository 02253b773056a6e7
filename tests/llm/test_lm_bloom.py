"""Scores from the log-frequency filter against counts kept in dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldsync.llm import lm_bloom
from fieldsync.llm.catalog import op11_lm_bloom

DIRECTORY = "/root/testdata/sf0.001"


def tokens(text):
    lowered = (text or "").translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    return [*(w for w in lowered.split(" ") if w), lm_bloom.END]


def level_value(n):
    return lm_bloom.VALUES[lm_bloom.levels_of(np.array([n]))[0]] if n else 0.0


class Plain:
    """The same model with exact levels, from dictionaries."""

    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for text in texts:
            line = [None, *tokens(text)]
            self.one.update(line)
            self.two.update(zip(line, line[1:], strict=False))
        begins = self.one.pop(None, 0)
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.one[None] = begins

    def base(self, text):
        return sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))

    def score(self, text):
        line, total = [None, *tokens(text)], 0.0
        for h, w in zip(line, line[1:], strict=False):
            word, history, joint = level_value(self.one[w]), level_value(self.one[h]), level_value(self.two[h, w])
            p = (word + 1) / (self.n + self.v + 1)
            total += math.log10(min(1, (min(joint, history) + lm_bloom.MU * p) / (history + lm_bloom.MU)))
        return total


def check(rows, texts, plain, tolerance):
    near = 0
    for r in rows:
        own = tokens(texts[r.doc_id])
        assert r.n_tokens == len(own) and r.n_known == sum(plain.one[w] > 0 for w in own) and r.train_tokens == plain.n
        assert math.isclose(r.base_score, plain.base(texts[r.doc_id]), rel_tol=1e-9, abs_tol=1e-9)
        near += math.isclose(r.score, plain.score(texts[r.doc_id]), rel_tol=tolerance, abs_tol=1e-6)
        assert r.score <= 0
    return near


def test_levels():
    assert [lm_bloom.levels_of(np.array([c]))[0] for c in (1, 2, 3, 4, 5, 6, 8)] == [1, 2, 3, 4, 4, 5, 6]
    counts = np.arange(1, 100_000)
    values = lm_bloom.VALUES[lm_bloom.levels_of(counts)]
    assert (np.abs(values - counts) <= 0.25 * counts).all() and (np.diff(values) >= 0).all()


@pytest.mark.parametrize("shards", [1, 8])
def test_filter(shards):
    random = np.random.default_rng(1)
    keys = np.unique(random.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2))
    levels = random.integers(1, 12, len(keys)).astype(np.uint8)
    of = lm_bloom.shard_of(keys, shards.bit_length() - 1)
    filter_ = lm_bloom.Filter([lm_bloom.made(keys[of == s], levels[of == s]) for s in range(shards)])
    found = filter_.levels(keys)
    assert (found >= levels).all() and (found > levels).mean() < 0.02
    others = np.unique(random.integers(0, 1 << 63, 60_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    assert (filter_.levels(others) > 0).mean() < 0.02


@pytest.mark.parametrize("limits", [{}, {"FREQUENT": 3}, {"BROADCAST": 0, "SHARD_BYTES": 4000, "BLOCK_ROWS": 2, "GATHERED": 3000, "FREQUENT": 20}])
def test_small_corpus(documents, odd_rows, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(lm_bloom, name, value)
    rows = [*odd_rows[:8], *odd_rows[9:], (11, "The cat SAT on the mat, the END"), (12, "the cat\vsat\x85on the mat\x1c"), (13, "É ist é")]
    docs = documents(rows)
    model = lm_bloom.fitted(docs)
    assert (model.filter is None) == ("BROADCAST" in limits)
    made = lm_bloom.scored(docs, model).collect()
    assert len(made) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    assert check(made, texts, Plain(r[1] for r in rows), 0.02) >= len(made) - 1


def test_both_ways_agree(spark, monkeypatch):
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    train = docs.where("doc_id % 3 <> 0")
    one = {tuple(r) for r in lm_bloom.scored(docs, lm_bloom.fitted(train)).select("doc_id", "score").collect()}
    monkeypatch.setattr(lm_bloom, "BROADCAST", 0)
    model = lm_bloom.fitted(train)
    assert model.filter is None
    assert {tuple(r) for r in lm_bloom.scored(docs, model).select("doc_id", "score").collect()} == one


def test_no_training_rows_and_no_rows(documents, odd_rows):
    docs = documents(odd_rows)
    model = lm_bloom.fitted(docs.where("false"))
    made = lm_bloom.scored(docs, model).collect()
    assert len(made) == len(odd_rows) and all(r.train_tokens == r.n_known == 0 and r.score == r.base_score == 0 for r in made)
    assert lm_bloom.scored(docs.where("false"), lm_bloom.fitted(docs)).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").collect()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    plain = Plain(t for i, t in texts.items() if not out[i])
    made = op11_lm_bloom(spark, DIRECTORY).collect()
    assert len(made) == len(texts) and all(r.held_out == out[r.doc_id] for r in made)
    assert check(made, texts, plain, 0.02) > 0.98 * len(made)
    held = [r for r in made if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)
