"""SimHash fingerprints and components against brute force."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from fieldsync.llm import vptree
from fieldsync.llm.catalog import op6_vptree


def fingerprint(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(points, distance=3):
    f = np.array([x for _, x in points], np.uint64)
    group = list(range(len(f)))
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f) <= distance).tolist():
            a, b = group[i], group[j]
            if a != b:
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for (i, _), g in zip(points, group, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return Counter((i, f"{x:016x}", least.get(g)) for (i, x), g in zip(points, group, strict=True))


def found(df):
    return Counter((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in df.collect())


@pytest.mark.parametrize("shard, part, leaf", [(20_000, 60_000, 96), (30, 11, 4)])
def test_given_tables(spark, monkeypatch, shard, part, leaf):
    for name, value in (("SHARD", shard), ("PART", part), ("LEAF", leaf)):
        monkeypatch.setattr(vptree, name, value)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    made = Counter(tuple(r) for r in op6_vptree(spark, "/root/testdata/sf0.001").collect())
    assert made == components([(r.doc_id, fingerprint(r.text)) for r in docs])


def test_odd_rows(documents, odd_rows):
    assert found(vptree.near_duplicates(documents(odd_rows))) == components([(d, fingerprint(t)) for d, t in odd_rows])
    assert vptree.near_duplicates(documents([])).collect() == []
    nameless = [(None, "a b c d"), (None, "a b c d"), (None, "quite other words than those"), (5, "")]
    assert found(vptree.near_duplicates(documents(nameless))) == components([(d, fingerprint(t)) for d, t in nameless])


def test_kept_rows(documents, odd_rows):
    kept = vptree.without_near_duplicates(documents(odd_rows)).collect()
    expected = {c for _, _, c in components([(d, fingerprint(t)) for d, t in odd_rows])}
    assert Counter(r.doc_id for r in kept) == Counter(expected)


@pytest.mark.parametrize("seed", range(6))
def test_links(spark, monkeypatch, seed):
    """Dense groups, equal halves and strangers, over many shards and parts: nothing that is linked is missed."""
    monkeypatch.setattr(vptree, "SHARD", 25)
    monkeypatch.setattr(vptree, "PART", 13)
    monkeypatch.setattr(vptree, "LEAF", 4)
    random = np.random.default_rng(seed)
    centres = random.integers(0, 2**63, 12).tolist()
    values = set(random.integers(0, 2**63, 60).tolist())
    for c in centres:
        values |= {c ^ int(sum(1 << int(b) for b in set(random.integers(0, 64, random.integers(0, 4)).tolist()))) for _ in range(25)}
    values |= {(7 << 32) | int(x) for x in random.integers(0, 2**32, 60)}
    points = [(i, v) for i, v in enumerate(sorted(values))]
    rows = spark.createDataFrame([(i, v - 2**64 if v >= 2**63 else v) for i, v in points], "id long, fingerprint long")
    made = {r.id: r.component for r in vptree.components(vptree.links(rows)).collect()}
    assert Counter((i, f"{v:016x}", made.get(i, i)) for i, v in points) == components(points)


def test_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 103), (103, 101), (200, 200)]
    made = {r.id: r.component for r in vptree.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert made == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}
