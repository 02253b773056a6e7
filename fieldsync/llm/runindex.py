"""Repeated byte strings found with run-length indexes.

A window is `window` consecutive bytes of one document. Windows travel to buckets in segments: consecutive
windows that choose the same minimiser, so that equal windows always meet. Equal segments are put together
by each task and again by the bucket: all their windows repeat. Over the different segments whose minimiser
comes more than once, a bucket builds a run-length index: the Burrows-Wheeler transform of their text is cut
into runs of equal letters, and only at the ends of runs the place and the length of the match with the
neighbour in suffix order are sampled. Between samples matching statistics follow in text order, one less
with each byte, so every window's longest match elsewhere is streamed from the samples of its run ends, and
windows that match for their whole length are marked. The index has as many samples as the transform has
runs, which in repetitive text are few.

Bytes covered by a marked window are removed, the first occurrence too. Null and empty texts have no bytes.
Null and repeated `doc_id` are no matter: each row is a document of its own (rows with equal id and text
share their result). Any other columns stay. An empty table gives an empty one.
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

#: Bytes of a window, and of the grams among which its minimiser is chosen (a power of two).
WINDOW, GRAM = 200, 16
#: Bytes of text hashed at once; segments that a task gathers before it sends them on.
CHUNK, GATHERED = 1 << 20, 24 << 20
#: The top bits of a gram's rank are compared, the others hold its place.
PLACE_BITS = 24

_LETTERS = S.mixed(np.arange(1, 257, dtype=np.uint64) * S._ODD)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each `GRAM` bytes, by doubling."""
    out, reach, factor = _LETTERS[data], 1, 0x100000001B3
    while reach < GRAM:
        out = out[:-reach] * np.uint64(factor) + out[reach:]
        factor = factor * factor % 2**64
        reach *= 2
    return S.mixed(out)


def text_gram_hashes(text: bytes) -> np.ndarray:
    return gram_hashes(np.frombuffer(text, np.uint8)) if len(text) >= GRAM else np.empty(0, np.uint64)


def segments(data: np.ndarray, valid: np.ndarray, table: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each segment. The leftmost of equal grams counts."""
    hashes = gram_hashes(data)
    slots = np.uint64((1 << S.SLOT_BITS) - 1)
    ranked = (hashes >> np.uint64(1)) | (table[hashes & slots] << np.uint64(63))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = S.least((ranked & ~low) | np.arange(len(ranked), dtype=np.uint64), window - GRAM + 1)
    head, tail = valid.copy(), valid.copy()
    head[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    tail[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    first = np.flatnonzero(head)
    return first, np.flatnonzero(tail) - first + 1, least[first] >> np.uint64(PLACE_BITS)


class Gathered:
    """Segments of a task on their way to their buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.zip = buckets, zstandard.ZstdCompressor(level=3)
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.anchors, self.parts, self.size = [], [], 0

    def add(self, strings: list[bytes], anchors: np.ndarray, keys: np.ndarray, ties: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> None:
        before, index = len(self.index), self.index
        ids = np.array([index.setdefault(s, len(index)) for s in strings], np.int64)
        new = np.flatnonzero(ids >= before)
        _, first = np.unique(ids[new], return_index=True)
        self.anchors.append(anchors[new[first]])
        self.size += sum(map(len, strings))
        self.parts.append((ids, keys, ties, starts, counts))

    def sent(self) -> Iterator[pa.RecordBatch]:
        """Each different segment once; where it has come more than once its windows are marked at once."""
        if not self.index:
            return
        ids, keys, ties, starts, counts = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        anchors, strings = np.concatenate(self.anchors), [*self.index]
        times = np.bincount(ids, minlength=len(strings))
        one = np.zeros(len(strings), np.int64)
        one[ids] = np.arange(len(ids))
        rows = []
        again = times[ids] > 1
        if again.any():
            rows.append((int(keys[again][0] % self.buckets), None, S.pack_runs(keys[again], ties[again], starts[again], counts[again])))
        bucket = (anchors % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
        rest = (anchors // np.uint64(self.buckets)).astype(np.uint32)
        for a, b in zip(cuts, np.append(cuts[1:], len(order)), strict=True):
            here = order[a:b]
            at = one[here]
            head = [np.int64(b - a), keys[at], starts[at], rest[here], ties[at].astype(np.int32), (times[here] > 1).astype(np.uint8)]
            rows.append((int(bucket[here[0]]), self.zip.compress(b"".join(x.tobytes() for x in head) + b"\xff".join([strings[i] for i in here.tolist()])), None))
        self.clear()
        for i in range(0, len(rows), 64):
            part = rows[i : i + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int32()), pa.array([r[1] for r in part], pa.binary()), pa.array([r[2] for r in part], pa.binary())], names=["bucket", "packed", "runs"])


def packer(window: int, buckets: int, frequent):
    """The function of a task that cuts texts into segments."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, gathered = S.slot_table(frequent), Gathered(buckets)
        for keys, ties, texts in S.steps(batches):
            data = np.frombuffer(b"".join(texts), np.uint8)
            ends = np.cumsum([len(t) for t in texts])
            for origin in range(0, len(data) - window + 1, CHUNK):
                part = data[origin : origin + CHUNK + window - 1]
                n = len(part) - window + 1
                of = np.searchsorted(ends, np.arange(origin, origin + n), side="right")
                valid = np.arange(origin, origin + n) + window <= ends[of]
                first, counts, anchors = segments(part, valid, table, window)
                view = part.tobytes()
                strings = [view[a:b] for a, b in zip(first.tolist(), (first + counts + window - 1).tolist(), strict=True)]
                if not strings:
                    continue
                of = of[first]
                gathered.add(strings, anchors, keys[of], ties[of], first + origin - (ends[of] - np.array([len(texts[i]) for i in of.tolist()])), counts)
                if gathered.size >= GATHERED:
                    yield from gathered.sent()
        yield from gathered.sent()

    return pack


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling; only groups not yet told apart are sorted again."""
    n, reach = len(text), 8
    padded = np.append(text, np.zeros(reach, np.uint8))
    keys = np.zeros(n, np.uint64)
    for i in range(reach):
        keys = (keys << np.uint64(8)) | padded[i : i + n]
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.append(True, keys[1:] != keys[:-1])
    head = np.flatnonzero(fresh)
    rank = np.zeros(n + 1, np.int64)
    rank[order] = head[np.cumsum(fresh) - 1] + 1
    while True:
        open_ = ~(fresh & np.append(fresh[1:], True))
        at = np.flatnonzero(open_)
        if not len(at):
            break
        suffixes = order[at]
        keys = (rank[suffixes] << 32) | rank[np.minimum(suffixes + reach, n)]
        by = np.argsort(keys)
        keys, suffixes = keys[by], suffixes[by]
        order[at] = suffixes
        new = np.append(True, keys[1:] != keys[:-1])
        fresh[at] = new
        rank[suffixes] = at[np.flatnonzero(new)][np.cumsum(new) - 1] + 1
        reach *= 2
    return order


def matches(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the match of the suffixes at a and at b, eight bytes at a time."""
    n = len(text)
    padded = np.append(text, np.zeros(16, np.uint8))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(len(a), np.int64)
    live = np.flatnonzero(np.maximum(a, b) < n)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = np.maximum(x, y) < n
        live, x, y = live[inside], x[inside], y[inside]
        differ = words[x] != words[y]
        equal = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        out[live] += equal
        live = live[equal == 8]
    return np.minimum(out, n - np.maximum(a, b))


def streamed(places: np.ndarray, lengths: np.ndarray, n: int, window: int) -> np.ndarray:
    """Changes in the number of samples that tell of a match of `window` bytes, in text order: a sample's length falls by one with each byte up to the next sample."""
    order = np.argsort(places)
    places, lengths = places[order], lengths[order]
    until = np.minimum(np.append(places[1:], n), places + lengths - window + 1)
    some = until > places
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, places[some], 1)
    np.add.at(change, until[some], -1)
    return change


def repeated_in(text: np.ndarray, window: int) -> np.ndarray:
    """Starts of windows that come elsewhere in a text too, as a mask, from its run-length index."""
    n = len(text)
    if n <= window:
        return np.zeros(n, bool)
    order = suffix_order(text)
    letters = text[order - 1]  # the Burrows-Wheeler transform
    cut = np.flatnonzero(letters[1:] != letters[:-1])  # the last of each run but the final one
    lengths = matches(text, order[cut], order[cut + 1])
    # what stands before the first byte of a text is no letter: its place is sampled in either case
    first = int(np.flatnonzero(order == 0)[0])
    near = np.array([first - 1, first]) if 0 < first < n - 1 else np.array([max(0, first - 1)])
    edges = np.concatenate([cut, near])
    lengths = np.concatenate([lengths, matches(text, order[near], order[near + 1])])
    below, above = order[edges], order[edges + 1]
    below, below_length = unique_longest(below, lengths)
    above, above_length = unique_longest(above, lengths)
    # the first suffix has none before it, the last none after it
    above, above_length = np.append(above, order[0]), np.append(above_length, 0)
    below, below_length = np.append(below, order[-1]), np.append(below_length, 0)
    change = streamed(below, below_length, n, window) + streamed(above, above_length, n, window)
    return np.cumsum(change)[:n] > 0


def unique_longest(places: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((-lengths, places))
    places, lengths = places[order], lengths[order]
    head = np.append(True, places[1:] != places[:-1]) if len(places) else np.zeros(0, bool)
    return places[head], lengths[head]


def marker(window: int):
    """The function of a bucket that marks windows which come more than once."""

    def mark(table: pa.Table) -> pa.Table:
        found, parts = [], []
        unzip = zstandard.ZstdDecompressor()
        for packed, runs in zip(table.column("packed").to_pylist(), table.column("runs").to_pylist(), strict=True):
            if runs is not None:
                found.append(S.unpack_runs(runs))
            if packed is not None:
                parts.append(unzip.decompress(packed))
        if parts:
            index: dict[bytes, int] = {}
            columns = []
            for p in parts:
                n, at, cols = int(np.frombuffer(p, np.int64, 1)[0]), 8, []
                for kind in (np.int64, np.int64, np.uint32, np.int32, np.uint8):
                    cols.append(np.frombuffer(p, kind, n, at))
                    at += n * np.dtype(kind).itemsize
                ids = np.array([index.setdefault(s, len(index)) for s in p[at:].split(b"\xff")], np.int64)
                columns.append((ids, *cols))
            ids, keys, starts, anchors, ties, again = (np.concatenate(x) for x in zip(*columns, strict=True))
            del parts, columns
            strings = [*index]
            sizes = np.array([*map(len, strings)], np.int64)
            whole = np.bincount(ids, weights=again, minlength=len(strings)) + np.bincount(ids, minlength=len(strings)) > 1
            known = whole[ids]
            found.append((keys[known], ties[known], starts[known], sizes[ids[known]] - window + 1))
            one = np.zeros(len(strings), np.int64)
            one[ids] = np.arange(len(ids))
            _, group, size = np.unique(anchors[one], return_inverse=True, return_counts=True)
            shared = np.flatnonzero(size[group] > 1)
            if len(shared):
                shared = shared[np.argsort(group[shared], kind="stable")]
                text = np.frombuffer(b"\xff".join([strings[i] for i in shared.tolist()]) + b"\xff", np.uint8)
                mask = repeated_in(text, window)
                ends = np.cumsum(sizes[shared] + 1) - 1
                begins = ends - sizes[shared]
                of = np.repeat(np.arange(len(shared)), sizes[shared] + 1)
                at = np.flatnonzero(mask)
                at = at[at + window <= ends[of[at]]]
                at = at[~whole[shared[of[at]]]]
                # segments left here have come once: one row each
                row = one[shared[of[at]]]
                found.append((keys[row], ties[row], starts[row] + at - begins[of[at]], np.ones(len(at), np.int64)))
        return S.run_rows(*(np.concatenate(x) for x in zip(*found, strict=True)))

    return mark


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Spans of window starts (key, tie, start, count) whose bytes also start elsewhere."""
    ship_code(docs.sparkSession)
    rows = S.keyed(docs, doc_id, text)
    n, size = S.extent(rows)
    frequent = S.frequent_slots(rows, n, text_gram_hashes)
    packed = rows.mapInArrow(packer(window, S.buckets_for(size), frequent), S.PACKED_SCHEMA)
    return packed.groupBy("bucket").applyInArrow(marker(window), S.RUN_SCHEMA)


def remove_matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, out: str = "removal") -> DataFrame:
    """`docs` with a column `out` of n_bytes, n_removed, n_spans (runs of removed bytes) and the kept bytes."""
    found = S.with_spans(docs, S.spans_by_document(repeated_windows(docs, doc_id, text, window)), doc_id, text)

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def removed(texts: pa.Array, spans: pa.Array) -> pa.Array:
        parts = [cut(texts.slice(first, n), spans.slice(first, n)) for first, n in cuts(texts)]
        return pa.concat_arrays(parts) if parts else cut(texts, spans)

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        sizes, gone, runs, kept = [], [], [], []
        for i, t in enumerate(texts.cast(pa.binary()).to_pylist()):
            data = t or b""
            sizes.append(len(data))
            if not spans[i].is_valid:
                gone.append(0)
                runs.append(0)
                kept.append(data)
                continue
            mask = S.covered(spans, i, window, len(data))
            gone.append(int(mask.sum()))
            runs.append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(np.frombuffer(data, np.uint8)[~mask].tobytes())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], names=["n_bytes", "n_removed", "n_spans", "kept"])

    return found.withColumn(out, removed(F.col(text), F.col(S.SPANS))).drop(S.SPANS)
