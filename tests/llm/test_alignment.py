"""Alignment against byte ranges compared one by one."""

import hashlib
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldsync.llm import alignment
from fieldsync.llm.catalog import PIECES, TOKENIZER, op13_alignment

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ranges(strings):
    at, made = 0, []
    for s in strings:
        made.append((at, at + len(s)))
        at += len(s)
    return made


def plain(libraries, text):
    """Ids, groups as text and links of one text."""
    from fieldsync.llm.bpe import byte_characters

    a, b = libraries
    of = byte_characters()
    whole = b" " + (text or "").encode()
    ids_a, ids_b = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
    bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return [], [], "", []
    ra, rb = ranges(bytes_a), ranges(bytes_b)
    links, groups, i, k, own = [], [], 0, 0, ([], [])
    while i < len(ra):  # the token that ends first makes way
        (s, e), (u, v) = ra[i], rb[k]
        assert max(s, u) < min(e, v)
        links.append((ids_a[i], ids_b[k]))
        if e <= v:
            own[0].append(str(ids_a[i]))
            i += 1
        if v <= e:
            own[1].append(str(ids_b[k]))
            k += 1
        if e == v:
            groups.append(",".join(own[0]) + "|" + ",".join(own[1]))
            own = ([], [])
    return ids_a, ids_b, ";".join(groups), links


def expected(libraries, rows):
    held = [plain(libraries, t) for _, t in rows]
    counts = Counter(p for *_, links in held for p in set(links))
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    made = []
    for (i, _), (a, b, groups, links) in zip(rows, held, strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        made.append((i, len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(counts[p] == top[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return sorted(made, key=repr)


def query(docs):
    from pyspark.sql import functions as F

    made = alignment.aligned(docs, TOKENIZER, PIECES)
    made = made.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))).drop("groups")
    counted = alignment.with_counts(made, alignment.pieces_of(PIECES))
    return sorted((tuple(r) for r in counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


CASES = ["internationalisation", "  two  spaces", "a\n\n\tb", "<|endoftext|> <s> </s>", "café naïve", "\U0001f600\U0001f600 漢字", "▁ low line", "é ﬁ ½", "x\x00y", " ", "ไทย", "12345 67.89", "tokens tokens tokens"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5])
def test_small_corpus(documents, odd_rows, libraries, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rows = [(i, t[:3000] if t else t) for i, t in odd_rows] + list(enumerate(CASES, 100)) + [(None, CASES[0]), (200, CASES[0])]
    made = query(documents(rows))
    assert made == expected(libraries, rows)
    assert any(r[1] == 0 for r in made) and any(r[3] < min(r[1], r[2]) for r in made)


def test_long_text(documents, libraries):
    text = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    (row,) = alignment.aligned(documents([(1, text)]), TOKENIZER, PIECES).collect()
    a, b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    groups = [tuple(part.split("|")) for part in row.groups.split(";")]
    assert [int(i) for x, _ in groups for i in x.split(",")] == a and [int(i) for _, y in groups for i in y.split(",")] == b
    assert row.n_links == sum(x.count(",") + y.count(",") + 1 for x, y in groups) == sum(row.times)


def test_empty_table(documents):
    assert query(documents([])) == []
    assert query(documents([(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DIRECTORY}/documents.parquet").select("doc_id", "text").collect()]
    made = sorted((tuple(r) for r in op13_alignment(spark, DIRECTORY).collect()), key=repr)
    assert made == expected(libraries, rows)
