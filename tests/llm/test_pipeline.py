"""The pipeline's stages against plain versions of what they decide."""

from collections import Counter
from hashlib import md5
from math import isqrt

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fieldsync.llm import superkmers, toxicity
from fieldsync.llm.catalog import TOKENIZER

from .test_passages import words_left
from .test_vptree import components, fingerprint

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = spark.read.parquet(f"{DIRECTORY}/documents.parquet")
    out = [docs]
    for i, (_, work) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        work(spark, out[-1], DIRECTORY).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_columns(stages):
    assert [s.columns for s in stages[:5]] == [stages[0].columns] * 5
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "mixing", "bpe"]


def test_toxicity(spark, stages):
    lexicon = toxicity.learned(stages[0], spark.read.parquet(f"{DIRECTORY}/labels.parquet"))
    rows = stages[0].collect()
    assert Counter(stages[1].collect()) == Counter(r for r in rows if lexicon.score(lexicon.evidence(r.text)[0]) < toxicity.THRESHOLD)
    assert 0 < stages[1].count() < len(rows)


def test_near_duplicates(stages):
    rows = stages[1].collect()
    kept = {c for _, _, c in components([(r.doc_id, fingerprint(r.text)) for r in rows])}
    assert Counter(stages[2].collect()) == Counter(r for r in rows if r.doc_id in kept)
    assert len(kept) < len(rows)


def test_passages(stages):
    rows = stages[2].collect()
    left = {d: (gone, t) for d, _, gone, t in words_left([(r.doc_id, r.text) for r in rows], superkmers.WINDOW)}
    made = {r.doc_id: r for r in stages[3].collect()}
    assert set(made) == {r.doc_id for r in rows}
    for r in rows:
        gone, text = left[r.doc_id]
        assert made[r.doc_id].text == (text if gone else r.text)
        assert made[r.doc_id].n_chars == (len(text) if gone else r.n_chars)


def test_mixing_keeps_all(stages):
    assert Counter(stages[4].collect()) == Counter(stages[3].collect())


def test_coding(stages):
    library = Tokenizer.from_file(TOKENIZER)
    made = {r.doc_id: r for r in stages[5].collect()}
    assert len(made) == stages[4].count()
    for r in stages[4].collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert (made[r.doc_id].ids, made[r.doc_id].n_tokens, made[r.doc_id].round_trip) == (ids, len(ids), True)


def test_run(spark, stages):
    columns = ["doc_id", "n_tokens", "ids"]
    rows = corpus_pipeline.run(spark, DIRECTORY).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, stages[5].select(*columns).collect()))


def test_odd_documents(spark, documents, odd_rows, tmp_path):
    """Nulls, repeated rows and extra columns go through all stages."""
    docs = documents(odd_rows)
    for i, (_, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, docs, DIRECTORY).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert docs.columns == documents([]).columns
    assert docs.count() > 0
    empty = documents([])
    for _, work in corpus_pipeline.STAGES:
        assert work(spark, empty, DIRECTORY).count() == 0


def test_positions_follow_the_schedule(spark, stages, monkeypatch):
    """The result carries the order of a schedule worked out by hand over the rows that come to mixing."""
    block = 1 << 12
    interleaved = corpus_pipeline.mixing.interleaved
    monkeypatch.setattr(corpus_pipeline.mixing, "interleaved", lambda docs, weights: interleaved(docs, weights, block=block))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("substring_dedup", lambda s, d, _: stages[3]), *corpus_pipeline.STAGES[3:]])
    made = sorted(corpus_pipeline.run(spark, DIRECTORY).select("position", "doc_id").collect())
    at, queues = Counter(), {}
    for r in sorted(stages[3].collect(), key=lambda r: (md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)):
        queues.setdefault(r.source or "", []).append((at[r.source or ""], r.doc_id))
        at[r.source or ""] += max(1, len((r.text or "").encode()))
    weights = {s: isqrt(n) for s, n in at.items()}
    blocks, following, slots, t, total = {s: -(-n // block) for s, n in at.items()}, Counter(), {}, 0, sum(weights.values())
    while left := [s for s in weights if following[s] < blocks[s]]:
        t = max(t, min(following[s] * total // weights[s] for s in left))
        s = min((-(-(following[s] + 1) * total // weights[s]), s) for s in left if following[s] * total // weights[s] <= t)[1]
        slots[s, following[s]] = t
        following[s], t = following[s] + 1, t + 1
    order = sorted((slots[s, begins // block], begins % block, d) for s, queue in queues.items() for begins, d in queue)
    assert [r.doc_id for r in made] == [d for *_, d in order] and len({r.position for r in made}) == len(made)
    assert len(slots) > 2 * len(weights)
