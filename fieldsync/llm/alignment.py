"""Alignment of the tokens that two tokenizers make of the same text.

A codes a space and the text, B the text (it puts the space before it itself). The bytes of A's and of B's tokens, joined, are
both the space and the text; where they are not, or the text is null or empty, it has no tokens at all. The ends of A's tokens,
in bytes, go into a dictionary from end to index, B's into another. The ends in both, sorted, cut the two id lists into
groups. Within a group's slices the tokens whose bytes overlap are linked: each stretch between ends of either kind is
one link. A space between two visible characters begins a token in both vocabularies, so its place is an end in both
dictionaries whatever surrounds it: texts are cut there, and what was found for a word is remembered for its next occurrence. A text
with a word whose bytes don't come back is coded again as a whole.

A pair of ids counts once per document that holds it linked, over the whole corpus: documents' distinct pairs are counted by
a hash aggregate. Each document's links then get their pair's count: the pairs held by most documents, up to
`FREQUENT` of them, by a broadcast of that bounded size, and the others, each of which few documents hold, by a join. So no pair makes a
task hot. The highest count of an A id is one number per vocabulary entry.

Texts are coded whole, by the libraries that publish the vocabularies, whose files the driver reads and broadcasts (their size is fixed). Rows that
repeat an id, or are equal, are documents of their own. A null `doc_id` is a value like others. An empty table gives an
empty one. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain
from operator import itemgetter
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import cuts, give_back, ship_code, texts_of
from fieldsync.llm.bpe import byte_characters
from fieldsync.llm.heavy import threshold
from fieldsync.sources.staging import stage

#: Pairs whose counts are broadcast, at most.
FREQUENT = 1 << 20
#: Words remembered per Python worker, twice: those since the last clearing and those before it; bytes of text that are worked on at a time.
REMEMBERED, STEP = 350_000, 1 << 20
#: A space that begins a token in both vocabularies.
WORD = re.compile(r"(?<=[^ ▁]) (?=[^\s▁])")


class ByteLevel:
    """A: a byte-level vocabulary of the tokenizers library; strings of special tokens in a text are plain text."""

    def __init__(self, described: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(described.decode())
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        byte_of = byte_characters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.strings = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
        for string, i in vocabulary.items():
            self.strings[i] = bytes(byte_of[c] for c in string)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """B: a sentencepiece model with byte fallback."""

    def __init__(self, described: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=described)
        self.strings = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.strings.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligned(NamedTuple):
    """Groups as text (`a1,a2|b1;a3|b2,b3`), the pair of each link as bytes, and the numbers of tokens."""

    groups: str
    links: bytes
    n_a: int
    n_b: int


NONE = Aligned("", b"", 0, 0)


class Aligner:
    """Both tokenizers, the bytes of each id, and the words aligned lately."""

    def __init__(self, a: bytes, b: bytes):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.lengths = [[len(s) for s in x.strings] for x in (self.a, self.b)]
        self.names = [[str(i) for i in range(len(x.strings))] for x in (self.a, self.b)]
        #: No piece of B reaches from a word into the next.
        self.cuts_words = not any(b" " in s.lstrip(b" ") for s in self.b.strings)
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}

    def same(self, text: str, a: list[int], b: list[int]) -> bool:
        whole = b" " + text.encode()
        return b"".join(map(self.a.strings.__getitem__, a)) == whole == b"".join(map(self.b.strings.__getitem__, b))

    def align(self, a: list[int], b: list[int]) -> Aligned:
        """Groups and links of two codings of the same bytes."""
        (length_a, length_b), (name_a, name_b), size = self.lengths, self.names, len(self.b.strings)
        at_a = dict(zip(accumulate([length_a[x] for x in a]), range(1, len(a) + 1), strict=True))
        at_b = dict(zip(accumulate([length_b[x] for x in b]), range(1, len(b) + 1), strict=True))
        groups, links, i, k = [], [], 0, 0
        for end in sorted(at_a.keys() & at_b.keys()):
            j, m = at_a[end], at_b[end]
            if j - i == 1 and m - k == 1:
                x, y = a[i], b[k]
                groups.append(f"{name_a[x]}|{name_b[y]}")
                links.append(x * size + y)
            else:
                groups.append(f"{','.join([name_a[x] for x in a[i:j]])}|{','.join([name_b[y] for y in b[k:m]])}")
                if j - i == 1:
                    links += [a[i] * size + y for y in b[k:m]]
                elif m - k == 1:
                    links += [x * size + b[k] for x in a[i:j]]
                else:
                    links += self.overlapping(a[i:j], b[k:m])
            i, k = j, m
        return Aligned(";".join(groups), array("q", links).tobytes(), len(a), len(b))

    def overlapping(self, a: list[int], b: list[int]) -> list[int]:
        """Links of one group: of two tokens that share bytes, the one that ends first makes way."""
        (length_a, length_b), size = self.lengths, len(self.b.strings)
        links, k, end_a, end_b = [], 0, 0, length_b[b[0]]
        for x in a:
            begin, end_a = end_a, end_a + length_a[x]
            if end_b <= begin:
                k += 1
                end_b += length_b[b[k]]
            links.append(x * size + b[k])
            while end_b < end_a:
                k += 1
                end_b += length_b[b[k]]
                links.append(x * size + b[k])
        return links

    def of(self, texts: list[str]) -> list[Aligned | None]:
        """Of each text; None if its bytes don't come back."""
        return [self.align(a, b) if self.same(t, a, b) else None for t, a, b in zip(texts, self.a.encode(texts), self.b.encode(texts), strict=True)]

    def batch(self, texts: list[str]) -> list[Aligned]:
        """Of each text, by words; texts that are empty or don't come back have nothing."""
        if not self.cuts_words:
            return [x if x is not None and t else NONE for t, x in zip(texts, self.of(texts), strict=True)]
        cut = [WORD.split(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        unknown = set(chain.from_iterable(cut)).difference(known)
        known.update({w: older[w] for w in unknown.intersection(older)})
        unknown = [w for w in unknown if w not in older]
        known.update(zip(unknown, self.of(unknown), strict=True))
        made = []
        for text, words in zip(texts, cut, strict=True):
            parts = list(map(known.__getitem__, words))
            if None in parts:
                (whole,) = self.of([text])
                made.append(whole if whole is not None else NONE)
            else:
                counts = (sum(map(itemgetter(i), parts)) for i in (2, 3))
                made.append(Aligned(";".join(map(itemgetter(0), parts)), b"".join(map(itemgetter(1), parts)), *counts))
        return made


_aligners: dict[int, Aligner] = {}


def aligner_of(files) -> Aligner:
    """One aligner per Python worker and pair of vocabularies."""
    key = hash(files.value)
    if key not in _aligners:
        _aligners[key] = Aligner(*files.value)
    return _aligners[key]


def aligned(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, `groups` (as text: `a1,a2|b1;a3|b2,b3`), and its linked pairs: `pairs` (a * B's size + b) and how often (`times`)."""
    spark = docs.sparkSession
    ship_code(spark)
    files = spark.sparkContext.broadcast((Path(path_a).read_bytes(), Path(path_b).read_bytes()))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(files)
        for batch in batches:
            for first, n in cuts(batch.column(1), STEP):
                made = aligner.batch(texts_of(batch.column(1).slice(first, n)))
                links = [np.frombuffer(x.links, np.int64) for x in made]
                pairs, times = zip(*(np.unique(x, return_counts=True) for x in links), strict=True)
                ends = pa.array(np.cumsum([0, *map(len, pairs)], dtype=np.int32))
                columns = {
                    "doc_id": batch.column(0).slice(first, n),
                    "n_a": pa.array([x.n_a for x in made], pa.int64()),
                    "n_b": pa.array([x.n_b for x in made], pa.int64()),
                    "n_groups": pa.array([x.groups.count("|") for x in made], pa.int64()),
                    "n_links": pa.array(list(map(len, links)), pa.int64()),
                    "groups": pa.array([x.groups for x in made], pa.string()),
                    "pairs": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(pairs))),
                    "times": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times).astype(np.int32))),
                }
                yield pa.RecordBatch.from_pydict(columns)
                del made, links, pairs, times, columns
        give_back()

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(align, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<bigint>, times array<int>")


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """pair, n (documents that hold it linked) and `best` (no pair of the same A id is in more)."""
    counts = stage(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "alignment-counts")
    a = F.expr(f"pair div {size_b}").alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("top"))
    return counts.withColumn("a", F.expr(f"pair div {size_b}")).join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def with_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """`rows` (of `aligned`, any columns but `row`, n_best, count_sum) with n_best, the links whose pair is the A id's most common, and count_sum, the pairs' counts over the links."""
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "alignment-rows")
    counts = stage(pair_counts(rows, size_b), "alignment-pairs")
    least = threshold(counts, "n", FREQUENT)
    linked = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    often = F.broadcast(counts.where(F.col("n") >= least))  # at most FREQUENT rows

    def summed(found: DataFrame) -> DataFrame:
        return found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))

    sums = summed(linked.join(often, "pair"))
    if least > 1:
        rare = linked.join(often, "pair", "left_anti").join(counts.where(F.col("n") < least), "pair")
        sums = sums.unionByName(summed(rare)).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return rows.join(sums, "row", "left").drop("row", "pairs", "times").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})


def pieces_of(path_b: str) -> int:
    """Size of B's vocabulary."""
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=path_b).get_piece_size()
