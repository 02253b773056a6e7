"""Byte-pair encoding and decoding with the vocabulary of a public tokenizer.

A piece of text (as the pre-tokenizer cuts it) starts as a doubly linked list of one symbol per byte. A
priority queue holds the rank and place of every pair that can merge; the lowest rank, and the leftmost
place among equals, is merged first. A queue entry whose pair is no longer what it was when it was put in
is stale and skipped. Decoding concatenates the vocabulary's strings.

Whole texts are coded row by row where they lie: no shuffle, no state between rows but a bounded memory of
pieces already coded. The vocabulary (a file of fixed size) is read by the driver and broadcast once.

Null and empty texts have no ids and decode to the empty text. Rows are independent: repeated rows give
repeated results, an empty table an empty one, other columns stay as they are.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsync.llm.batches import cuts, give_back, ship_code, texts_of

#: How byte-level vocabularies cut a text, as published with them. A fixed value.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space before white space, or at the end: only there may a piece hold more than a leading space.
LOOSE = re.compile(r" (?:\s|\Z)")
#: Words remembered per Python worker, twice: those since the last clearing and those before it.
REMEMBERED = 350_000
#: Longer words are coded but not remembered.
REMEMBERED_LENGTH = 64
#: Code points that may be a letter, a digit or white space: the planes between hold no characters, the last two are private. Fixed values.
PLANES = (range(0x80, 0xD800), range(0xE000, 0x40000), range(0xE0000, 0xE1000))


@cache
def told_apart() -> frozenset[str]:
    """Characters that the regex library and the tokenizers library, by their Unicode tables, hold for different kinds: letter, digit, white space or none."""
    from tokenizers.pre_tokenizers import ByteLevel

    library, found = ByteLevel(add_prefix_space=False), set()
    for c in map(chr, chain(*PLANES)):
        probe = f"a{c}1{c}!{c}"  # cut in another way for each kind
        if [probe[a:b] for _, (a, b) in library.pre_tokenize_str(probe)] != PIECE.findall(probe):
            found.add(c)
    return frozenset(found)


def byte_characters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself where it is printable, else the next free one from 256."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memory(dict):
    """What a function made of short texts: of those asked for lately, and of those before them."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        made = self.older.get(text)
        if made is None:
            made = self.make(text)
        if len(text) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = made
        return made


class Coder:
    """Encode and decode single texts."""

    def __init__(self, described: bytes, apart: frozenset[str]):
        """The tokenizer's file, and the characters that only its library cuts as it should."""
        self.apart = apart
        tokenizer = json.loads(described)
        vocabulary = tokenizer["model"]["vocab"]
        bytes_of = byte_characters()
        self.first = [0] * 256
        for character, byte in bytes_of.items():
            self.first[byte] = vocabulary[character]
        #: By left id the ranks of its merges by right id; what a rank makes.
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(vocabulary.values()) + 1)]
        self.makes = []
        for rank, merge in enumerate(tokenizer["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[vocabulary[left]][vocabulary[right]] = rank
            self.makes.append(vocabulary[left + right])
        self.byte_ranks = [[self.ranks[a].get(b) for b in self.first] for a in self.first]
        self.strings = [b""] * (1 + max([*vocabulary.values(), *(x["id"] for x in tokenizer["added_tokens"])]))
        for string, i in vocabulary.items():
            self.strings[i] = bytes(bytes_of[c] for c in string)
        self.added = {x["content"]: x["id"] for x in tokenizer["added_tokens"]}
        for content, i in self.added.items():
            self.strings[i] = content.encode()
        self.cut_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.words = Memory(lambda word: self.cut(" " + word))

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        first, byte_ranks, makes, rank_by = self.first, self.byte_ranks, self.makes, self.ranks
        symbols = [first[b] for b in piece]
        ranks = [byte_ranks[a][b] for a, b in zip(piece, piece[1:])]  # noqa: B905
        n = len(symbols)
        places = n.bit_length()
        queue = [r << places | i for i, r in enumerate(ranks) if r is not None]
        if not queue:
            return symbols
        ranks.append(None)
        heapq.heapify(queue)
        mask = (1 << places) - 1
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        while queue:
            entry = heapq.heappop(queue)
            i, rank = entry & mask, entry >> places
            if ranks[i] != rank:
                continue  # stale: the pair at this place is another by now
            symbols[i] = made = makes[rank]
            j = after[i]
            after[i] = k = after[j]
            symbols[j] = -1
            ranks[j] = ranks[i] = None
            if k < n:
                before[k] = i
                if (rank := rank_by[made].get(symbols[k])) is not None:
                    ranks[i] = rank
                    heapq.heappush(queue, rank << places | i)
            if (h := before[i]) >= 0:
                ranks[h] = rank = rank_by[symbols[h]].get(made)
                if rank is not None:
                    heapq.heappush(queue, rank << places | h)
        return [x for x in symbols if x >= 0]

    def cut(self, text: str) -> bytes:
        """Ids of a text as 32-bit numbers, cut into pieces."""
        if not text.isascii() and not self.apart.isdisjoint(text):
            from tokenizers.pre_tokenizers import ByteLevel

            cuts = [text[a:b] for _, (a, b) in ByteLevel(add_prefix_space=False).pre_tokenize_str(text)]
        else:
            cuts = PIECE.findall(text)
        return array("i", [i for c in cuts for i in self.merged(c.encode())]).tobytes()

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens. A piece begins at each space that no white space follows."""
        if LOOSE.search(text):
            return self.cut(text)
        first, *words = text.split(" ")
        return self.cut(first) + b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        if self.cut_at is None or not any(x in text for x in self.added):
            return np.frombuffer(self.plain(text), np.int32)
        parts = self.cut_at.split(text)
        return np.frombuffer(b"".join(np.int32(self.added[p]).tobytes() if i % 2 else self.plain(p) for i, p in enumerate(parts)), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.strings.__getitem__, ids.tolist())).decode("utf-8", "replace")


_coders: dict[int, Coder] = {}


def coder_of(described) -> Coder:
    """One coder per Python worker and broadcast vocabulary."""
    key = hash(described.value)
    if key not in _coders:
        _coders[key] = Coder(*described.value)
    return _coders[key]


def vocabulary(spark: SparkSession, path: str):
    """Broadcast a tokenizer file, with the characters that libraries differ on: of fixed size, whatever the corpus."""
    return spark.sparkContext.broadcast((Path(path).read_bytes(), told_apart()))


def coded(text: Column, described) -> Column:
    """Ids of a text, and the text they decode to."""

    @F.arrow_udf("ids array<int>, decoded string")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(described)
        for texts in batches:
            made = []
            for first, n in cuts(texts):
                ids = [coder.encode(t) for t in texts_of(texts.slice(first, n))]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
                made.append(pa.StructArray.from_arrays([lists, pa.array(map(coder.decode, ids), pa.string())], names=["ids", "decoded"]))
            yield pa.concat_arrays(made) if made else pa.array([], pa.struct({"ids": pa.list_(pa.int32()), "decoded": pa.string()}))
            del made, texts
        give_back()

    return code(text)


def decoded(ids: Column, described) -> Column:
    """The text of an array of ids; null has none."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = coder_of(described)
        for lists in batches:
            yield pa.array([coder.decode(np.array(x, np.int32)) if x is not None else None for x in lists.to_pylist()], pa.string())

    return decode(ids)


def encode_decode(docs: DataFrame, path: str, text: str = "text", out: str = "coded") -> DataFrame:
    """`docs` with a column `out` of the ids of each whole text and the text they decode to."""
    ship_code(docs.sparkSession)
    return docs.withColumn(out, coded(F.coalesce(F.col(text), F.lit("")), vocabulary(docs.sparkSession, path)))
