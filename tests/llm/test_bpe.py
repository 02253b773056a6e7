"""Byte-pair coding against the tokenizers library."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldsync.llm import bpe
from fieldsync.llm.catalog import TOKENIZER, op1_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


CODER = bpe.Coder(open(TOKENIZER, "rb").read(), bpe.told_apart())


def same(library, text):
    ids = CODER.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert CODER.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "   ", "a  b", "a \nb", "a\n  b ", "\n a", "it's we'll I'D", "a<|endoftext|>b <|endoftext|>", "a" * 5000, "\x1c\x85y　 z", "Ա՘ x՘", "😀😀 é​", "<|endof text|>"],
)
def test_cases(library, text):
    same(library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(library, text):
    same(library, text)


def test_every_code_point(library):
    """Each one after a letter, a digit and a sign, and before an apostrophe: as the library cuts it."""
    points = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f"{c}'s a{c}'ll 1{c}2!{c} {c}x" for c in points[i : i + 16]) for i in range(0, len(points), 16)]
    for first in range(0, len(lines), 4096):
        part = lines[first : first + 4096]
        for text, coded in zip(part, library.encode_batch_fast(part, add_special_tokens=False), strict=True):
            assert CODER.encode(text).tolist() == coded.ids, repr(text)


def test_memory_runs_over(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    same(library, " ".join(f"word{i % 11} other{i % 7}" for i in range(200)))


def test_odd_rows(documents, odd_rows, library):
    made = bpe.encode_decode(documents(odd_rows), TOKENIZER).collect()
    assert len(made) == len(odd_rows)
    for r in made:
        assert list(r.coded.ids) == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.coded.decoded == (r.text or "")
    assert bpe.encode_decode(documents([]), TOKENIZER).collect() == []


def test_decoding_alone(spark, library):
    described = bpe.vocabulary(spark, TOKENIZER)
    rows = spark.createDataFrame([(1, [31373, 995]), (2, []), (3, None), (4, [172])], "i int, ids array<int>")
    made = {r.i: r.text for r in rows.select("i", bpe.decoded(rows.ids, described).alias("text")).collect()}
    assert made == {1: "hello world", 2: "", 3: None, 4: library.decode([172], skip_special_tokens=False)}


def test_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    made = op1_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(made) == len(texts)
    for r in made:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
