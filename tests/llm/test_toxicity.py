"""The automaton against edit distance, quotation, and held-out accuracy."""

import random

import pytest

from fieldsync.llm import toxicity
from fieldsync.llm.catalog import op2_toxicity


def begins_at(word, stem):
    """Fewest edits that make a beginning of the word the stem."""
    row = list(range(len(stem) + 1))
    best = row[-1]
    for i, letter in enumerate(word, 1):
        above, row = row, [i]
        for j, other in enumerate(stem, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (letter != other)))
        best = min(best, row[-1])
    return best


@pytest.mark.parametrize("seed", range(200))
def test_automaton(seed):
    r = random.Random(seed)
    stems = {"".join(r.choices("abc", k=r.randrange(3, 8))) for _ in range(6)}
    word = "".join(r.choices("abc", k=r.randrange(0, 10)))
    expected = {s: d for s in stems if (d := begins_at(word, s)) <= (1 if len(s) >= toxicity.EDITED else 0)}
    assert dict(toxicity.matching(word, toxicity.trie_of(stems), 1)) == expected
    lexicon = toxicity.Lexicon({(s, e, 1): 1.0 for s in stems for e in (0, 1)})
    assert dict(lexicon.looked_up(word)) == expected


def test_context():
    lexicon = toxicity.Lexicon({("idiot", e, level): 4.0 for e in (0, 1) for level in (1, 2, 3)}, 1.0, -2.0)
    factor = {t: [f for _, _, f in lexicon.hits(t)] for t in ("some idiot here", 'the "idiot" line', "they said idiot then", "you idiot", "«idiot", "an idiiot too")}
    assert factor == {
        "some idiot here": [1.0],
        'the "idiot" line': [0.25],
        "they said idiot then": [0.25],
        "you idiot": [1.25],
        "«idiot": [1.0],
        "an idiiot too": [1.0],
    }
    assert lexicon.evidence('the "idiot" line')[0] == 0 < lexicon.evidence("some idiot here")[0]


def test_learning(spark, documents):
    r = random.Random(5)
    plain = [f"{a}{b}{c}ennen" for a in "bdfgk" for b in ("alo", "eri", "umo", "ota") for c in "lmnrst"]
    rows, labels = [], []
    for i in range(600):
        words = [r.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words[3] = words[9] = "grobian" + r.choice(["", "s", "e"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs, known = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learned(docs, known)
    assert {s for s, *_ in lexicon.weights} == {"grobian"}
    odd = [(1, None), (2, ""), (3, "a grobian and grobians"), (3, "a grobian and grobians"), (None, "grobbian grobean grobiin"), (4, "word " * 50_000)]
    made = [(x.text, x.toxicity.score >= 0.7) for x in toxicity.scored(documents(odd), lexicon).collect()]
    assert sorted(made, key=str) == sorted([(t, "grob" in (t or "")) for _, t in odd], key=str)
    none = toxicity.learned(docs, known.where("toxic = 0"))
    assert none.score(none.evidence("grobian")[0]) < 1e-9
    assert toxicity.scored(documents([]), lexicon).collect() == []


def test_held_out_accuracy(spark):
    directory = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{directory}/labels.parquet")
    made = op2_toxicity(spark, directory).join(labels, "doc_id").collect()
    test = [r for r in made if r.held_out]
    assert 0.25 < len(test) / len(made) < 0.42
    right = sum(r.predicted == r.toxic for r in test) / len(test)
    found = [r.predicted for r in test if r.toxic]
    assert right > 0.97 and sum(found) / len(found) > 0.8
