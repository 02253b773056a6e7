r"""Language-model scores from a log-frequency Bloom filter.

Texts are lower-cased (A-Z) and cut into words `[^\x20\x09-\x0D]+`; one end token follows. The n-grams of the
training rows, up to `ORDER` words, are counted over the whole corpus. A count c has the level
1 + floor(log(c) / log(BASE)), and the filter holds the items (n-gram, 1), (n-gram, 2) up to its level. To read a
count, memberships are probed level after level until one is missing: a level is never too low, and too high
only with the filter's error. Probabilities are smoothed from such counts: a word's is add-one, and an n-gram's

    p(w | h) = (c(hw) + MU * p(w | shorter h)) / (c(h) + MU)

An n-gram counts as unseen where its word or its history is.

Every n-gram of the corpus is in the filter, which has `BITS` bits an item and so grows with the corpus. It is cut
into shards by the n-gram's hash, each made by one task from sums that tasks have added up before they send them; a
frequent n-gram is one entry per sender. A filter of up to `BROADCAST` bytes goes to the workers as a
broadcast. A larger one stays where it is: each block of rows sends its n-grams to their shards, gets their levels
back and is scored with them. Scores are the same either way.

The base score needs exact counts. Words that are frequent (at most `FREQUENT` of them) are broadcast with theirs;
the others, which no row holds often, meet their counts in a join. Words are told apart by 64 bits of XXH64: of V
words about V * V / 2^65 pairs are taken for one.

Null and empty texts have the end token alone. A null `doc_id` trains and is a value like others. Rows that repeat
an id, or are equal, are rows of their own, in training and in the result. Without training rows every count is 0.
An empty table gives an empty one. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import cuts, give_back, ship_code, texts_of
from fieldsync.llm.heavy import threshold
from fieldsync.sources.staging import stage

#: Longest n-gram; base of the levels; weight of the shorter history; bits of filter an item.
ORDER, BASE, MU, BITS = 2, 1.5, 500.0, 10
#: Words whose exact counts are broadcast, at most (16 bytes each); bytes of a filter that is broadcast.
FREQUENT, BROADCAST = 1 << 18, 128 << 20
#: Bytes of training text to a shard; bytes of text a task gathers before it sends; rows of a block of the dealt way.
SHARD_BYTES, GATHERED, BLOCK_ROWS = 32 << 20, 16 << 20, 1 << 10
#: Words remembered with their hash per Python worker.
REMEMBERED = 200_000

_ITEM = np.uint64(0x9E3779B97F4A7C15)
_JOIN = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    """Rows that don't train."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 11)


#: No word holds a space, so these are no words.
BEGIN, END = token_hash(b" begin"), token_hash(b" end")


class Hashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        made = token_hash(word)
        if len(word) <= 64:
            self[word] = made
        return made


_hashes = Hashes()


@dataclass
class Tokens:
    """Tokens of some texts in a row, each text led by `BEGIN`: hashes, place within the text, where each text starts."""

    hashes: np.ndarray
    place: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Tokens:
        found, sizes = [], []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").lower().split()
            found.append(BEGIN)
            found.extend(map(_hashes.__getitem__, words))
            found.append(END)
            sizes.append(len(words) + 2)
        ends = np.cumsum(sizes, dtype=np.int64)
        starts = ends - sizes
        place = np.arange(len(found)) - np.repeat(starts, sizes)
        return cls(np.array(found, np.uint64), place, starts)

    def grams(self, order: int = ORDER) -> list[np.ndarray]:
        """For 1 to `order` words the key of the n-gram that ends at each place; n-grams that would begin before their text are none."""
        keys = [mixed(self.hashes)]
        for _ in range(1, order):
            longer = np.zeros(len(self.hashes), np.uint64)
            longer[1:] = mixed(keys[-1][:-1] * _JOIN + self.hashes[1:])
            keys.append(longer)
        return keys


BEGIN_KEY = int(mixed(np.array([BEGIN], np.uint64))[0])


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(all_keys, kind="stable")
    all_keys, all_counts = all_keys[order], all_counts[order]
    first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]])) if len(all_keys) else np.empty(0, np.int64)
    return all_keys[first], np.add.reduceat(all_counts, first) if len(first) else all_counts


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(_BOUNDS, counts, side="right").astype(np.uint8)


def _levels() -> tuple[np.ndarray, np.ndarray]:
    """Least count of each level from 1, without levels that hold no whole number; the count that stands for each level, from 0."""
    bounds = np.unique(np.ceil(BASE ** np.arange(0, 62 / math.log2(BASE))).astype(np.float64))
    return bounds, np.concatenate([[0.0], (bounds[:-1] + bounds[1:] - 1) / 2, bounds[-1:]])


_BOUNDS, VALUES = _levels()


class Filter:
    """The shards' bits, one after the other. An item has three bits in each of two words."""

    def __init__(self, shards: list[np.ndarray]):
        self.bits = max(0, (len(shards) - 1).bit_length())
        self.sizes = np.array([len(s) for s in shards], np.uint64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.words = np.concatenate(shards)

    def places(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        h = mixed(keys + np.uint64(level * int(_ITEM) & (1 << 64) - 1))
        shard = shard_of(keys, self.bits)
        size, offset = self.sizes[shard], self.offsets[shard]
        low = np.uint64(0xFFFFFFFF)
        first, second = offset + ((h >> np.uint64(32)) * size >> np.uint64(32)), offset + ((h & low) * size >> np.uint64(32))
        g = mixed(h ^ _JOIN)
        masks = []
        for at in (0, 18):
            mask = np.zeros(len(keys), np.uint64)
            for i in range(3):
                mask |= np.uint64(1) << ((g >> np.uint64(at + 6 * i)) & np.uint64(63))
            masks.append(mask)
        return first, masks[0], second, masks[1]

    def add(self, keys: np.ndarray, level: int) -> None:
        first, one, second, two = self.places(keys, level)
        np.bitwise_or.at(self.words, first, one)
        np.bitwise_or.at(self.words, second, two)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram: probes go on until one fails."""
        found, asked = np.zeros(len(keys), np.uint8), np.arange(len(keys))
        for level in range(1, len(VALUES)):
            first, one, second, two = self.places(keys[asked], level)
            there = ((self.words[first] & one) == one) & ((self.words[second] & two) == two)
            asked = asked[there]
            if not len(asked):
                break
            found[asked] = level
        return found


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def made(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The bits of one shard."""
    items = int(levels.sum(dtype=np.int64))
    shard = Filter([np.zeros(max(1, -(-items * BITS // 64)), np.uint64)])
    for level in range(1, int(levels.max(initial=0)) + 1):
        shard.add(keys[levels >= level], level)
    return shard.words


@dataclass
class Model:
    """Counts of a corpus: the filter (broadcast, or as a table of shards), exact counts of words, and their totals."""

    shards: DataFrame
    bits: int
    filter: object | None
    words: DataFrame
    frequent: object
    tokens: int
    distinct: int


def counted(texts: DataFrame, bits: int) -> DataFrame:
    """shard, n, keys and counts: n-grams of n words, added up as far as one task sees them before it sends."""

    def sent(keys: list, counts: list, n: int) -> Iterator[pa.RecordBatch]:
        held, sums = summed(keys, counts)
        cut = np.searchsorted(shard_of(held, bits), np.arange((1 << bits) + 1))
        for shard in range(1 << bits):
            a, b = cut[shard], cut[shard + 1]
            if b > a:
                row = [pa.array([shard], pa.int32()), pa.array([n], pa.int32()), pa.array([held[a:b].tobytes()]), pa.array([sums[a:b].astype(np.int32).tobytes()])]
                yield pa.RecordBatch.from_arrays(row, names=["shard", "n", "keys", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, gathered = [[] for _ in range(ORDER)], [[] for _ in range(ORDER)], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for n in range(ORDER):
                if keys[n]:
                    yield from sent(keys[n], counts[n], n + 1)
                    keys[n].clear()
                    counts[n].clear()

        for batch in batches:
            for first, rows in cuts(batch.column(0)):
                piece = texts_of(batch.column(0).slice(first, rows))
                tokens = Tokens.of(piece)
                for n, grams in enumerate(tokens.grams()):
                    unique, times = np.unique(grams[tokens.place >= n], return_counts=True)
                    keys[n].append(unique)
                    counts[n].append(times)
                gathered += sum(map(len, piece))
                if gathered >= GATHERED:
                    yield from flushed()
                    gathered = 0
        yield from flushed()
        give_back()

    return texts.mapInArrow(count, "shard int, n int, keys binary, counts binary")


def sharded(parts: DataFrame) -> DataFrame:
    """Per shard its bits, and the words' keys and exact counts."""

    def shard(table: pa.Table) -> pa.Table:
        words, keys, levels = (np.empty(0, np.uint64), np.empty(0, np.int64)), [], []
        for n in range(1, ORDER + 1):
            rows = table.filter(pc.equal(table.column("n"), n))
            if rows.num_rows:
                held = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("keys")]
                sums = summed(held, [np.frombuffer(x.as_buffer(), np.int32).astype(np.int64) for x in rows.column("counts")])
                words = sums if n == 1 else words
                keys.append(sums[0])
                levels.append(levels_of(sums[1]))
        bits = made(np.concatenate(keys), np.concatenate(levels))
        row = {"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "bits": [bits.tobytes()], "keys": [words[0].tobytes()], "counts": [words[1].tobytes()]}
        give_back()
        return pa.table(row)

    return parts.groupBy("shard").applyInArrow(shard, "shard int, bits binary, keys binary, counts binary")


def word_counts(shards: DataFrame) -> DataFrame:
    """key and n of each word."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1), strict=True):
                held, n = np.frombuffer(keys.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.int64)
                real = held != np.uint64(BEGIN_KEY)
                yield pa.RecordBatch.from_arrays([pa.array(held[real].view(np.int64)), pa.array(n[real])], names=["key", "n"])

    return shards.select("keys", "counts").mapInArrow(unpacked, "key long, n long")


def fitted(docs: DataFrame, text: str = "text") -> Model:
    """The model of all rows of `docs`."""
    spark = docs.sparkSession
    ship_code(spark)
    texts = docs.select(F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, math.ceil(size / SHARD_BYTES) - 1).bit_length()
    shards = stage(sharded(counted(texts, bits)), "lm-shards")
    words = stage(word_counts(shards), "lm-words")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    often = words.where(F.col("n") >= threshold(words, "n", FREQUENT)).toArrow().sort_by("key")
    frequent = spark.sparkContext.broadcast((often.column("key").to_numpy(), often.column("n").to_numpy()))
    held = shards.agg(F.sum(F.octet_length("bits").cast("long"))).first()[0] or 0
    probed = None
    if held <= BROADCAST:
        parts = [np.zeros(1, np.uint64) for _ in range(1 << bits)]
        held_ = shards.select("shard", "bits").toArrow()  # `BROADCAST` bytes at most
        for shard, words_ in zip(held_.column("shard").to_pylist(), held_.column("bits"), strict=True):
            parts[shard] = np.frombuffer(words_.as_buffer(), np.uint64)
        made_ = Filter(parts)
        del held_, parts
        probed = spark.sparkContext.broadcast(made_)
    return Model(shards, bits, probed, words, frequent, int(totals[0]), int(totals[1]))


def log10_scores(tokens: Tokens, grams: list[np.ndarray], levels: Callable[[np.ndarray], np.ndarray], n: int, v: int) -> np.ndarray:
    """The model's log10 probability of each text."""
    held = []
    for keys in grams:
        unique, at = np.unique(keys, return_inverse=True)
        held.append(VALUES[levels(unique)][at])
    p = (held[0] + 1) / (n + v + 1)
    for k in range(1, len(grams)):
        history = np.zeros(len(p))
        history[1:] = held[k - 1][:-1]
        history[tokens.place < k] = 0
        joint = np.where(held[0] > 0, np.minimum(held[k], history), 0)
        p = (joint + MU * p) / (history + MU)
    logs = np.log10(np.minimum(p, 1.0))
    logs[tokens.place == 0] = 0
    return np.add.reduceat(logs, tokens.starts)


def base_parts(tokens: Tokens, words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> dict[str, pa.Array]:
    """Per text: tokens, sum and number over its frequent words, and its other words with how often they come."""
    texts = len(tokens.starts)
    real = tokens.place > 0
    text_at = np.cumsum(~real) - 1
    unique, at = np.unique(words[real].view(np.int64), return_inverse=True)
    often, counts = frequent
    where = np.minimum(np.searchsorted(often, unique), max(0, len(often) - 1))
    hit = (often[where] == unique) if len(often) else np.zeros(len(unique), bool)
    n = np.where(hit, counts[where], 0) if len(often) else np.zeros(len(unique), np.int64)
    of = text_at[real]
    sums = np.bincount(of, np.log10(n + 1.0)[at], texts)
    known = np.bincount(of, hit[at], texts).astype(np.int64)
    rest = ~hit[at]
    pairs, times = np.unique(of[rest] * len(unique) + at[rest], return_counts=True)
    ends = np.searchsorted(pairs, np.arange(texts + 1) * len(unique)).astype(np.int32)
    others = pa.StructArray.from_arrays([pa.array(unique[pairs % max(1, len(unique))]), pa.array(times.astype(np.int64))], names=["key", "times"])
    return {
        "n_tokens": pa.array(np.bincount(of, minlength=texts).astype(np.int64)),
        "sum": pa.array(sums),
        "known": pa.array(known),
        "others": pa.ListArray.from_arrays(pa.array(ends), others),
    }


def schema_of(rows: DataFrame) -> str:
    return f"row long, doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, sum double, known long, others array<struct<key: bigint, times: bigint>>, score double"


def scored_batch(batch: pa.RecordBatch, levels: Callable, frequent: tuple, n: int, v: int) -> Iterator[pa.RecordBatch]:
    """Results of rows (row, doc_id, text), a run of texts at a time."""
    for first, m in cuts(batch.column("text")):
        part = batch.slice(first, m)
        tokens = Tokens.of(texts_of(part.column("text")))
        grams = tokens.grams()
        made_ = {"row": part.column("row"), "doc_id": part.column("doc_id")} | base_parts(tokens, grams[0], frequent)
        yield pa.RecordBatch.from_pydict(made_ | {"score": pa.array(log10_scores(tokens, grams, levels, n, v))})


def by_broadcast(rows: DataFrame, model: Model) -> DataFrame:
    probed, frequent, n, v = model.filter, model.frequent, model.tokens, model.distinct

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from scored_batch(batch, probed.value.levels, frequent.value, n, v)
        give_back()

    return rows.mapInArrow(score, schema_of(rows))


def by_shards(rows: DataFrame, model: Model) -> DataFrame:
    """As `by_broadcast`, with the n-grams sent to the shards of the filter and their levels sent back."""
    bits, frequent, n, v = model.bits, model.frequent, model.tokens, model.distinct
    blocks = rows.withColumn("block", F.shiftright("row", (BLOCK_ROWS - 1).bit_length()))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            for value in np.unique(block):
                texts = batch.column("text").filter(pa.array(block == value))
                for first, m in cuts(texts):
                    keys = np.unique(np.concatenate(Tokens.of(texts_of(texts.slice(first, m))).grams()))
                    cut = np.searchsorted(shard_of(keys, bits), np.arange((1 << bits) + 1))
                    held = [i for i in range(1 << bits) if cut[i + 1] > cut[i]]
                    packed = [keys[cut[i] : cut[i + 1]].tobytes() for i in held]
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([value] * len(held), pa.int64()), pa.array(packed, pa.binary())], names=["shard", "block", "keys"])
        give_back()

    def answered(questions: pa.Table, shard: pa.Table) -> pa.Table:
        found = []
        words = np.frombuffer(shard.column("bits")[0].as_buffer(), np.uint64) if shard.num_rows else np.zeros(1, np.uint64)
        probed = Filter([words])
        for keys in questions.column("keys"):
            found.append(probed.levels(np.frombuffer(keys.as_buffer(), np.uint64)).tobytes())
        return pa.table({"block": questions.column("block"), "keys": questions.column("keys"), "levels": pa.array(found, pa.binary())})

    def score(_: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in answers.column("keys")])
        held = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in answers.column("levels")])
        order = np.argsort(keys, kind="stable")
        keys, held = keys[order], held[order]
        return pa.Table.from_batches([x for batch in texts.to_batches() for x in scored_batch(batch, lambda asked_: held[np.searchsorted(keys, asked_)], frequent.value, n, v)])

    questions = blocks.mapInArrow(asked, "shard int, block long, keys binary")
    answers = questions.groupBy("shard").cogroup(model.shards.select("shard", "bits").groupBy("shard")).applyInArrow(answered, "block long, keys binary, levels binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema_of(rows))


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score (add-one, exact counts) and score (the model's)."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if model.filter is not None:
        held = stage(by_broadcast(rows, model), "lm-scored")
    else:
        held = stage(by_shards(stage(rows, "lm-rows"), model), "lm-scored")
    others = held.select("row", F.explode("others").alias("x")).select("row", "x.*").join(model.words, "key")
    others = others.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("more_known"))
    found = held.drop("others").join(others, "row", "left")
    least = math.log10(model.tokens + model.distinct + 1)
    return found.select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("sum") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(least)).alias("base_score"),
        "score",
    )
