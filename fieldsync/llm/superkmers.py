"""Substring dedup by super-k-mer partitioning.

A window is `window` consecutive words of one document. Its minimiser is the least hash of the short runs of
words in it. Consecutive windows that share a minimiser travel as one packed string, words joined by one
space, to the minimiser's bucket, so that equal windows always meet. There sorting puts equal windows side
by side, their strings are compared, and all but the earliest are marked. Words covered by a marked window
are removed.

Every task first puts equal strings together and sends only their earliest occurrence on; the others are
marked where they are. So a passage or a group of copies that holds a third of all rows reaches a bucket
once per task.

Null and empty texts have no words. A null `doc_id` counts as the largest. Rows that repeat a `doc_id`
start at the same place: neither is earlier, both stay as they are. Any other columns stay. An empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.llm import spans as S
from fieldsync.llm.batches import cuts, ship_code

#: Words of a window, and of the runs among which its minimiser is chosen.
WINDOW, RUN = 20, 3
#: Bytes of packed strings that a task gathers before it sends them on.
GATHERED = 24 << 20
#: Bytes hashed at once.
HASHED = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    """Powers of an odd number modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


_powers = {"up": powers(_BASE, 0), "down": powers(_BASE, 0)}


def hashes_between(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice of the bytes; slices are in order of their starts."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, origin + HASHED)))
        size = int(ends[first:last].max() - origin)
        if len(_powers["up"]) <= size:
            _powers["up"], _powers["down"] = powers(_BASE, size + 1), powers(_INVERSE, size + 1)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[origin : origin + size].astype(np.uint64) + np.uint64(1)) * _powers["up"][:size], out=sums[1:])
        a, b = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = (sums[b] - sums[a]) * _powers["down"][a] + (b - a).astype(np.uint64)
        first = last
    return S.mixed(out)


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of some bytes joined by single spaces, and where they start and end in that."""
    space = _SPACE[data]
    kept = ~space
    kept[1:] |= ~space[:-1]  # the first white space after a word
    if len(data) and space[0]:
        kept[0] = False
    plain = data[kept]
    gap = _SPACE[plain]
    plain[gap] = 0x20
    ends = np.flatnonzero(gap)
    if len(plain) and not gap[-1]:
        ends = np.append(ends, len(plain))
    starts = np.append(0, ends[:-1] + 1) if len(ends) else ends
    return plain, starts, ends


def run_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of each run of `RUN` words."""
    out = words[: max(0, len(words) - RUN + 1)].copy()
    for i in range(1, RUN):
        out = out * S._ODD + words[i : len(words) - RUN + 1 + i]
    return S.mixed(out)


def text_run_hashes(text: bytes) -> np.ndarray:
    plain, starts, ends = words_of(np.frombuffer(text, np.uint8))
    return run_hashes(hashes_between(plain, starts, ends))


class Gathered:
    """Strings of a task on their way to their buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.zip = buckets, zstandard.ZstdCompressor(level=3)
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bucket, self.parts, self.size = [], [], 0

    def add(self, strings: list[bytes], bucket: np.ndarray, keys: np.ndarray, ties: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        before, index = len(self.index), self.index
        ids = np.array([index.setdefault(s, len(index)) for s in strings], np.int64)
        new = np.flatnonzero(ids >= before)
        _, first = np.unique(ids[new], return_index=True)
        self.bucket.append(bucket[new[first]])
        self.size += sum(map(len, strings))
        self.parts.append((ids, keys, ties, starts, counts))

    def sent(self) -> Iterator[pa.RecordBatch]:
        if not self.index:
            return
        ids, keys, ties, starts, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((starts, keys, ids))
        ids, keys, ties, starts, counts = (x[order] for x in (ids, keys, ties, starts, counts))
        head = np.append(True, ids[1:] != ids[:-1])
        least = np.flatnonzero(head)[np.cumsum(head) - 1]
        later = (keys != keys[least]) | (starts != starts[least])
        keys, ties, starts, counts, later = keys, ties, starts, counts, later
        rows = []
        if later.any():
            rows.append((int(keys[later][0] % self.buckets), None, S.pack_runs(keys[later], ties[later], starts[later], counts[later])))
        strings, bucket = [*self.index], np.concatenate(self.bucket)
        # rows that repeat a doc_id share its place: all of them are sent on, once each
        sent = np.flatnonzero(~later)
        by = np.argsort(bucket[ids[sent]], kind="stable")
        sent, of = sent[by], bucket[ids[sent]][by]
        cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        for a, b in zip(cuts, np.append(cuts[1:], len(of)), strict=True):
            here = sent[a:b]
            head = np.int64(b - a).tobytes() + keys[here].tobytes() + starts[here].astype(np.int32).tobytes() + ties[here].tobytes()
            rows.append((int(of[a]), self.zip.compress(head + b"\n".join([strings[i] for i in ids[here].tolist()])), None))
        self.clear()
        for i in range(0, len(rows), 64):
            part = rows[i : i + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary()), pa.array([r[2] for r in part], pa.binary())], names=["bucket", "packed", "runs"])


def packer(window: int, buckets: int, frequent):
    """The function of a task that packs windows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, gathered = S.slot_table(frequent), Gathered(buckets)
        slots, top = np.uint64((1 << S.SLOT_BITS) - 1), np.uint64(63)
        for keys, ties, texts in S.steps(batches):
            data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
            plain, starts, ends = words_of(data)
            counts = np.array([len(t.split()) for t in texts], np.int64)
            last = np.cumsum(counts)
            document = np.repeat(np.arange(len(texts)), counts)
            if len(starts) < window:
                continue
            hashes = run_hashes(hashes_between(plain, starts, ends))
            ranked = (hashes >> np.uint64(1)) | (table[hashes & slots] << top)
            least = S.least(ranked, window - RUN + 1)
            n = len(starts) - window + 1
            whole = document[:n] == document[window - 1 :]
            head = whole.copy()
            head[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
            first = np.flatnonzero(head)
            if not len(first):
                continue
            tail = whole.copy()
            tail[:-1] &= ~whole[1:] | (least[1:] != least[:-1])
            final = np.flatnonzero(tail)
            view = plain.tobytes()
            strings = [view[a:b] for a, b in zip(starts[first].tolist(), ends[final + window - 1].tolist(), strict=True)]
            of = document[first]
            gathered.add(strings, (S.mixed(least[first]) % np.uint64(buckets)).astype(np.int64), keys[of], ties[of], first - (last[of] - counts[of]), final - first + 1)
            if gathered.size >= GATHERED:
                yield from gathered.sent()
        yield from gathered.sent()

    return pack


def equal_windows(strings: bytes, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of packed strings, one per line: the hash of each window, its line, its place in it, and its bytes' bounds."""
    data = np.frombuffer(strings, np.uint8)
    gap = _SPACE[data]
    ends = np.append(np.flatnonzero(gap), len(data))
    starts = np.append(0, ends[:-1] + 1)
    line = np.cumsum(np.append(False, data[ends[:-1]] == 0x0A))
    n = len(starts) - window + 1
    at = np.flatnonzero(line[:n] == line[window - 1 :])
    place = at - np.searchsorted(line, line[at])
    bounds = np.stack([starts[at], ends[at + window - 1]])
    return hashes_between(data, bounds[0], bounds[1]), line[at], place, bounds


def marker(window: int):
    """The function of a bucket that marks all but the earliest of equal windows."""

    def mark(table: pa.Table) -> pa.Table:
        found, parts = [], []
        unzip = zstandard.ZstdDecompressor()
        for packed, runs in zip(table.column("packed").to_pylist(), table.column("runs").to_pylist(), strict=True):
            if runs is not None:
                found.append(S.unpack_runs(runs))
            if packed is not None:
                parts.append(unzip.decompress(packed))
        if parts:
            sizes = [int(np.frombuffer(p, np.int64, 1)[0]) for p in parts]
            keys = np.concatenate([np.frombuffer(p, np.int64, n, 8) for p, n in zip(parts, sizes, strict=True)])
            starts = np.concatenate([np.frombuffer(p, np.int32, n, 8 + 8 * n) for p, n in zip(parts, sizes, strict=True)])
            ties = np.concatenate([np.frombuffer(p, np.int32, n, 8 + 12 * n) for p, n in zip(parts, sizes, strict=True)])
            strings = b"\n".join([p[8 + 16 * n :] for p, n in zip(parts, sizes, strict=True)])
            del parts
            hashes, line, place, bounds = equal_windows(strings, window)
            order = np.argsort(hashes)
            ordered = hashes[order]
            same = ordered[1:] == ordered[:-1]
            again = np.append(same, False) | np.append(False, same)
            at = order[again]
            at = at[np.lexsort((starts[line[at]] + place[at], keys[line[at]], hashes[at]))]
            key, start, h = keys[line[at]], starts[line[at]].astype(np.int64) + place[at], hashes[at]
            marked = later_than_first(strings, bounds[0][at].tolist(), bounds[1][at].tolist(), h, key, start)
            at, key, start = at[marked], key[marked], start[marked]
            found.append((key, ties[line[at]], start, np.ones(len(at), np.int64)))
        return S.run_rows(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return mark


def later_than_first(strings: bytes, starts: list[int], ends: list[int], hashes: np.ndarray, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of the windows, sorted by hash and place, equal one that starts earlier. Equality is that of the strings."""
    marked = np.zeros(len(hashes), bool)
    if not len(hashes):
        return marked
    heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    for a, b in zip(heads.tolist(), np.append(heads[1:], len(hashes)).tolist(), strict=True):
        first: dict[bytes, int] = {}
        for i in range(a, b):
            j = first.setdefault(strings[starts[i] : ends[i]], i)
            marked[i] = i != j and (keys[i] != keys[j] or places[i] != places[j])
    return marked


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Spans of window starts (key, tie, start, count) whose words also start earlier."""
    ship_code(docs.sparkSession)
    rows = S.keyed(docs, doc_id, text)
    n, size = S.extent(rows)
    frequent = S.frequent_slots(rows, n, text_run_hashes)
    packed = rows.mapInArrow(packer(window, S.buckets_for(size), frequent), S.PACKED_SCHEMA)
    return packed.groupBy("bucket").applyInArrow(marker(window), S.RUN_SCHEMA)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, out: str = "removal") -> DataFrame:
    """`docs` with a column `out` of n_words, n_removed and the kept words joined by one space."""
    found = S.with_spans(docs, S.spans_by_document(repeated_windows(docs, doc_id, text, window)), doc_id, text)

    @F.arrow_udf("n_words long, n_removed long, kept string")
    def removed(texts: pa.Array, spans: pa.Array) -> pa.Array:
        parts = [cut(texts.slice(first, n), spans.slice(first, n)) for first, n in cuts(texts)]
        return pa.concat_arrays(parts) if parts else cut(texts, spans)

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        sizes, gone, kept = [], [], []
        for i, t in enumerate(texts.cast(pa.binary()).to_pylist()):
            words = (t or b"").split()
            mask = S.covered(spans, i, window, len(words))
            sizes.append(len(words))
            gone.append(int(mask.sum()))
            kept.append(b" ".join([words[j] for j in np.flatnonzero(~mask).tolist()] if gone[-1] else words).decode())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["n_words", "n_removed", "kept"])

    return found.withColumn(out, removed(F.col(text), F.col(S.SPANS))).drop(S.SPANS)
