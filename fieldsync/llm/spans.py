"""What the two operators on repeated passages share: row keys, frequent minimisers, windows' minima, and spans by document.

A window's minimiser is the smallest hash among the short pieces it holds. Pieces that a bounded sample
finds in many documents are ranked behind all others, so that a window which holds anything of its own
document goes by that, and only windows wholly inside a passage that many documents share meet in the
passage's bucket, where they are equal strings that every task has already put together. The sample decides
how work is dealt out, never what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import STEP_BYTES, give_back, pieces

#: Documents sampled to find frequent pieces (about; a bound on cost, not on what is searched).
SAMPLED = 2_000
#: A piece is frequent if it is in this share of the sampled documents, and in so many of them at least.
FREQUENT_SHARE, FREQUENT_LEAST = 0.01, 4
#: Frequent pieces are known by this many bits of their hash.
SLOT_BITS = 21
#: Bytes of text per bucket; a bucket is worked on by one task at a time.
BUCKET_BYTES = 4 << 20
#: Names of internal columns.
KEY, TIE, TEXT, START, COUNT, SPANS = "__key", "__tie", "__text", "__start", "__count", "__spans"
LAST_KEY = 2**63 - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Key, tie and text of each row. A null id counts as the largest; rows of one id are told apart by a hash of their text."""
    return docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_KEY)).alias(KEY),
        F.hash(F.col(text)).alias(TIE),
        F.coalesce(F.col(text), F.lit("")).alias(TEXT),
    )


def extent(rows: DataFrame) -> tuple[int, int]:
    """Rows and bytes of text."""
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length(TEXT))).first()
    return n, size or 0


def frequent_slots(rows: DataFrame, n: int, hashes: Callable[[bytes], np.ndarray]):
    """Broadcast bits, one per slot, that tell frequent pieces; of one size whatever the corpus."""
    slots = 1 << SLOT_BITS
    sample = rows.sample(min(1.0, SAMPLED / n), seed=7).select(TEXT) if n else rows.select(TEXT)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = np.zeros(slots, np.int32), 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                counts[np.unique(hashes(text) & np.uint64(slots - 1))] += 1
                documents += 1
        if documents:
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([*found.tolist(), -1], pa.int32()), pa.array([*counts[found].tolist(), documents], pa.int32())], names=["slot", "n"])

    counted = sample.mapInArrow(count, "slot int, n int").groupBy("slot").agg(F.sum("n").alias("n"))
    needed = max(FREQUENT_LEAST, int(FREQUENT_SHARE * min(n, SAMPLED)))
    table = np.zeros(slots, bool)
    table[[r["slot"] for r in counted.where((F.col("slot") >= 0) & (F.col("n") >= needed)).collect()]] = True
    return rows.sparkSession.sparkContext.broadcast(np.packbits(table).tobytes())


def slot_table(shared) -> np.ndarray:
    return np.unpackbits(np.frombuffer(shared.value, np.uint8)).astype(np.uint64)


def buckets_for(size: int) -> int:
    """So many that a bucket's share of the text stays bounded."""
    return max(8, -(-size // BUCKET_BYTES))


def steps(batches: Iterator[pa.RecordBatch], limit: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Keys, ties and texts of a task's rows, a bounded step at a time."""
    for batch in batches:
        for part in pieces(batch, TEXT, limit):
            yield part.column(KEY).to_numpy(), part.column(TIE).to_numpy(), part.column(TEXT).cast(pa.binary()).to_pylist()
    give_back()


def joined_runs(keys: np.ndarray, ties: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts, neighbours put together."""
    if not len(keys):
        return keys, ties, starts, counts
    order = np.lexsort((starts, ties, keys))
    keys, ties, starts, counts = keys[order], ties[order], starts[order], counts[order]
    first = np.ones(len(keys), bool)
    ends = starts + counts
    first[1:] = (keys[1:] != keys[:-1]) | (ties[1:] != ties[:-1]) | (starts[1:] != ends[:-1])
    heads = np.flatnonzero(first)
    return keys[heads], ties[heads], starts[heads], ends[np.append(heads[1:], len(keys)) - 1] - starts[heads]


#: Rows that a task emits and a bucket returns: packed passages of a bucket (`packed`), or runs of windows found repeated.
PACKED_SCHEMA = "bucket int, packed binary, runs binary"
RUN_SCHEMA = f"{KEY} long, {TIE} int, {START} long, {COUNT} long"


def run_rows(keys: np.ndarray, ties: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> pa.Table:
    keys, ties, starts, counts = joined_runs(keys, ties, starts, counts)
    return pa.table({KEY: pa.array(keys, pa.int64()), TIE: pa.array(ties, pa.int32()), START: pa.array(starts, pa.int64()), COUNT: pa.array(counts, pa.int64())})


def pack_runs(keys: np.ndarray, ties: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> bytes:
    keys, ties, starts, counts = joined_runs(keys, ties, starts, counts)
    return b"".join([np.int64(len(keys)).tobytes(), keys.astype(np.int64).tobytes(), starts.astype(np.int64).tobytes(), counts.astype(np.int64).tobytes(), ties.astype(np.int32).tobytes()])


def unpack_runs(packed: bytes) -> tuple[np.ndarray, ...]:
    n = int(np.frombuffer(packed, np.int64, 1)[0])
    keys, starts, counts = np.frombuffer(packed, np.int64, 3 * n, 8).reshape(3, n)
    return keys, np.frombuffer(packed, np.int32, n, 8 + 24 * n), starts, counts


def spans_by_document(runs: DataFrame) -> DataFrame:
    """One row per document with repeated windows: at most as many spans as the document has windows."""
    return runs.groupBy(KEY, TIE).agg(F.collect_list(F.struct(F.col(START).alias("start"), F.col(COUNT).alias("count"))).alias(SPANS))


def with_spans(docs: DataFrame, spans: DataFrame, doc_id: str, text: str) -> DataFrame:
    """`docs` with their spans; rows without any have null."""
    keys = docs.withColumn(KEY, F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST_KEY))).withColumn(TIE, F.hash(F.col(text)))
    return keys.join(spans, [KEY, TIE], "left").drop(KEY, TIE)


def covered(spans: pa.ListArray, row: int, window: int, size: int) -> np.ndarray:
    """Positions of a document that its spans' windows cover, as a mask."""
    a, b = spans.offsets[row].as_py(), spans.offsets[row + 1].as_py()
    mask = np.zeros(size + 1, np.int32)
    if a < b and spans[row].is_valid:
        starts = spans.values.field("start").slice(a, b - a).to_numpy()
        ends = starts + spans.values.field("count").slice(a, b - a).to_numpy() + window - 1
        np.add.at(mask, starts, 1)
        np.add.at(mask, np.minimum(ends, size), -1)
    return np.cumsum(mask)[:size] > 0


def hash_of_texts(text: Column) -> Column:
    return F.sha2(text, 256)
