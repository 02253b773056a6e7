"""Substring dedup and repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldsync.llm import runindex, spans, superkmers
from fieldsync.llm.catalog import op8_superkmers, op10_runindex

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_left(rows, window):
    first = {}
    texts = [(2**63 - 1 if d is None else d, WORD.findall((t or "").encode())) for d, t in rows]
    for d, w in texts:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, (d, i)), (d, i))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (d, i):
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return Counter(out)


def bytes_left(rows, window):
    count = Counter()
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, b in texts:
        count.update(b[i : i + window] for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + window + 1, int)
        for i in range(len(b) - window + 1):
            if count[b[i : i + window]] > 1:
                gone[i] += 1
                gone[i + window] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return Counter(out)


def generated(seed, n=120, vocabulary=40):
    r = random.Random(seed)
    shared = [" ".join(f"v{r.randrange(vocabulary)}" for _ in range(50)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = [r.choice(shared) if r.random() < 0.3 else " ".join(f"v{r.randrange(vocabulary)}" for _ in range(r.randrange(40))) for _ in range(r.randrange(5))]
        rows.append((i, r.choice([" ", "\n", "  "]).join(parts)))
    copy = rows[3][1] + " " + shared[0]
    return rows + [(1000 + i, copy.replace("v7", f"n{i}", 1)) for i in range(40)] + [(2000 + i, copy) for i in range(40)]


@pytest.mark.parametrize("window", [20, 5])
def test_words(documents, window):
    rows = generated(window)
    made = superkmers.remove_repeats(documents(rows), window=window).collect()
    assert Counter((r.doc_id, *r.removal) for r in made) == words_left(rows, window)


def test_words_of_odd_rows(documents, odd_rows):
    made = superkmers.remove_repeats(documents(odd_rows)).collect()
    assert Counter((2**63 - 1 if r.doc_id is None else r.doc_id, *r.removal) for r in made) == words_left(odd_rows, 20)
    assert {r["__extra"] for r in made} == {"x"}


def test_many_sendings(documents, monkeypatch):
    """A task that sends often, and buckets of all sizes, find the same."""
    monkeypatch.setattr(superkmers, "GATHERED", 500)
    monkeypatch.setattr(spans, "BUCKET_BYTES", 300)
    monkeypatch.setattr(superkmers, "HASHED", 64)
    rows = generated(1)
    made = superkmers.remove_repeats(documents(rows).repartition(7)).collect()
    assert Counter((r.doc_id, *r.removal) for r in made) == words_left(rows, 20)


def test_bytes(documents, monkeypatch):
    monkeypatch.setattr(spans, "BUCKET_BYTES", 2_000)
    rows = generated(2, n=60)
    made = runindex.remove_matches(documents(rows).repartition(5)).collect()
    assert Counter((r.doc_id, r.removal.n_bytes, r.removal.n_removed, r.removal.n_spans, bytes(r.removal.kept)) for r in made) == bytes_left(rows, 200)


def test_bytes_of_odd_rows(documents, odd_rows):
    rows = [r for r in odd_rows if r[0] != 7]
    made = runindex.remove_matches(documents(rows)).collect()
    assert Counter((r.doc_id, r.removal.n_bytes, r.removal.n_removed, r.removal.n_spans, bytes(r.removal.kept)) for r in made) == bytes_left(rows, 200)


def test_long_texts_in_chunks(documents, monkeypatch):
    monkeypatch.setattr(runindex, "CHUNK", 100)
    rows = generated(4, n=30)
    made = runindex.remove_matches(documents(rows)).collect()
    assert Counter((r.doc_id, r.removal.n_bytes, r.removal.n_removed, r.removal.n_spans, bytes(r.removal.kept)) for r in made) == bytes_left(rows, 200)


def test_empty_tables(documents):
    assert superkmers.remove_repeats(documents([])).collect() == []
    assert runindex.remove_matches(documents([])).collect() == []


@pytest.mark.parametrize("seed", range(150))
def test_index_of_a_text(seed):
    r = random.Random(seed)
    window = r.choice([2, 3, 5, 8, 12])
    text = bytes(r.choices(b"abcde"[: r.choice([1, 2, 4])], k=r.randrange(1, 250)))
    if r.random() < 0.6:
        text = text[: len(text) // 2] + b"\xff" + text[: len(text) // 3] + b"\xff" + text
    count = Counter(text[i : i + window] for i in range(len(text) - window + 1))
    expected = [i + window <= len(text) and count[text[i : i + window]] > 1 for i in range(len(text))]
    assert runindex.repeated_in(np.frombuffer(text, np.uint8), window).tolist() == expected


def test_suffixes_in_order():
    text = b"abracadabra" * 30 + b"\x00\x00ab\x00"
    assert runindex.suffix_order(np.frombuffer(text, np.uint8)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_queries_on_the_given_tables(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    made = op8_superkmers(spark, "/root/testdata/sf0.001").collect()
    assert Counter(tuple(r) for r in made) == Counter((d, n, gone, hashlib.sha256(t.encode()).hexdigest()) for d, n, gone, t in words_left(rows, 20))
    made = op10_runindex(spark, "/root/testdata/sf0.001").collect()
    assert Counter(tuple(r) for r in made) == Counter((*x, hashlib.sha256(b).hexdigest()) for *x, b in bytes_left(rows, 200))
