"""Hard negatives of anchors by rotated one-bit codes.

A vector's components become the integers floor(`SCALE` * x); its score with an anchor is their inner product.
What is left of a vector v is rotated and coded by the signs alone, `STAGES` times over: code s stands for a unit
vector o_s, whose alignment a_s = <left, o_s> is stored beside it, and a_s * o_s is taken off what is left. Then

    <v, q> = sum of a_s * <o_s, q>  +  <left, q>

An anchor q is rotated likewise and rounded to eight bits a component, so that <o_s, q> comes from popcounts of the
code with eight bit planes; the rounding is known. By Cauchy-Schwarz the last term is within |left| * |q|. So every
vector's score lies in a known interval, without chance. An interval that can't be among those asked for is dropped,
from stage to stage; what survives is scored in integers. Nothing is lost, whatever the vectors are.

Positives of an anchor are its `POSITIVES` best other rows of the same label. For each of them the first `NEGATIVES` rows of
another label whose score lies within `BAND` percent of the positive's are its hard negatives. Higher scores come first, ties go
by the smaller vec_id.

Rows are packed into blocks of about `ROWS`, anchors into blocks of about `ANCHORS`; a task sees one block of each. Every
anchor block meets every row block, twice: for the positives, and, once these are known for the whole table, for the
negatives. What the blocks have found of one anchor block is merged `MERGED` blocks at a time. All memory is bounded by these numbers.

Rows with a null id or label, or a null vector, or one with null or non-finite components, take no part; nor do rows whose
vector has not the most common length (the shorter of equally common ones), or a component beyond `LARGEST` after scaling, whose scores may not fit
64 bits. A zero vector is one like others. Of rows that repeat a `vec_id` the one with the least label, then the least vector, stays.
An empty table, or one without anchors, gives no rows. Other columns are not read and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import give_back, ship_code
from fieldsync.sources.staging import stage

#: Components become floor(SCALE * x); positives of an anchor; negatives of a positive; percent of a positive's score, least and greatest.
SCALE, POSITIVES, NEGATIVES, BAND = 256, 5, 10, (30, 90)
#: One-bit codes of a vector; bits of an anchor's component; stages before the first pruning.
STAGES, PLANES, EARLY = 6, 8, 3
#: Rows and anchors of a block, about; blocks whose finds are merged at once.
ROWS, ANCHORS, MERGED = 1 << 13, 1 << 10, 64
#: Largest component after scaling.
LARGEST = 1 << 24
#: Share of an interval's size that covers rounding in double precision.
_SLACK = 1e-9
_SEED = 20_240_601


def rotations(length: int) -> tuple[int, list[np.ndarray]]:
    """Words of a code, and for each stage a random rotation of that many bits: the same for the same length, wherever made."""
    words = -(-length // 64)
    random = np.random.default_rng([_SEED, length])
    return words, [np.linalg.qr(random.standard_normal((words * 64, words * 64)))[0] for _ in range(STAGES)]


def padded(vectors: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros((len(vectors), words * 64))
    out[:, : vectors.shape[1]] = vectors
    return out


def bits_of(flags: np.ndarray) -> np.ndarray:
    """64-bit words of rows of flags."""
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


class Codes:
    """Codes, alignments and the length of what is left after each stage, of some vectors."""

    def __init__(self, vectors: np.ndarray):
        words, turns = rotations(vectors.shape[1])
        left = padded(vectors.astype(np.float64), words)
        unit = np.sqrt(words * 64)
        self.codes, self.aligned, self.left = [], [], []
        for turn in turns:
            turned = left @ turn
            code = turned > 0
            signs = np.where(code, 1.0, -1.0) / unit
            aligned = (turned * signs).sum(axis=1)
            left = left - aligned[:, None] * (signs @ turn.T)
            self.codes.append(bits_of(code))
            self.aligned.append(aligned)
            self.left.append(np.sqrt((left * left).sum(axis=1)))
        self.size = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


class Query:
    """An anchor, rotated by each stage's turn and rounded to integers of `PLANES` bits, as bit planes."""

    def __init__(self, vector: np.ndarray, words: int, turns: list[np.ndarray]):
        q = padded(vector[None, :].astype(np.float64), words)[0]
        self.size = float(np.sqrt(q @ q))
        self.unit = np.sqrt(words * 64)
        self.stages = []
        half = 1 << (PLANES - 1)
        for turn in turns:
            turned = q @ turn
            step = max(float(np.abs(turned).max()) / (half - 1), 1e-300)
            whole = np.rint(turned / step)
            planes = [bits_of(((whole.astype(np.int64) + half) >> p & 1).astype(bool)) for p in range(PLANES)]
            self.stages.append((planes, step, float(whole.sum()), float(np.abs(turned - whole * step).sum()) / self.unit))

    def product(self, s: int, codes: np.ndarray) -> np.ndarray:
        """<o_s, q> of codes, but for the rounding."""
        planes, step, total, _ = self.stages[s]
        held = np.zeros(len(codes), np.int64)
        for p, plane in enumerate(planes):
            held += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << p
        held -= np.bitwise_count(codes).sum(axis=1, dtype=np.int64) << (PLANES - 1)
        return (2 * held - total) * (step / self.unit)

    def intervals(self, codes: Codes, rows: np.ndarray, so_far: np.ndarray, off: np.ndarray, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The sums of the estimates up to stage s, of their rounding, and half the interval, for some rows."""
        aligned = codes.aligned[s][rows]
        so_far = so_far + aligned * self.product(s, codes.codes[s][rows])
        off = off + np.abs(aligned) * self.stages[s][3]
        return so_far, off, off + codes.left[s][rows] * self.size + _SLACK * (1 + self.size * codes.size[rows])


def survivors(query: Query, codes: Codes, rows: np.ndarray, wanted) -> np.ndarray:
    """Rows whose interval may be among those asked for: `wanted` says so of lower and upper bounds."""
    so_far, off = np.zeros(len(rows)), np.zeros(len(rows))
    for s in range(STAGES):
        so_far, off, half = query.intervals(codes, rows, so_far, off, s)
        if s >= EARLY - 1:
            stay = wanted(so_far - half, so_far + half)
            rows, so_far, off = rows[stay], so_far[stay], off[stay]
    return rows


def highest(values: np.ndarray, n: int) -> float:
    """The n-th highest, or nothing to beat."""
    return float(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else -np.inf


def best_of(n: int):
    return lambda low, high: high >= highest(low, n)


def within(bands: list[tuple[float, float]], n: int):
    """Rows that may be among the n best of a band, for any of the bands."""

    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(low), bool)
        for least, most in bands:
            sure = (low >= least) & (high <= most)
            stay |= (high >= max(least, highest(low[sure], n))) & (low <= most)
        return stay

    return wanted


def band(score: int) -> tuple[int, int]:
    """Least and greatest negative score that goes with a positive's."""
    return -(-BAND[0] * score // 100), BAND[1] * score // 100


def scores(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return vectors.astype(np.int64) @ anchor.astype(np.int64)


def first(ids: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -values))[:n]
    return ids[order], values[order]


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label and whole (the scaled vector) of the rows that take part, one per vec_id."""
    whole = F.transform("vector", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) * SCALE <= LARGEST), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0)).where(finite)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("x")).select("vec_id", "x.label", "x.vector")
    return rows.select("vec_id", "label", whole.alias("whole"))


def packed(rows: DataFrame, blocks: int, seed: int, name: str) -> DataFrame:
    """One row per block: its number, and ids, labels and vectors as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        vectors = table.column("whole").combine_chunks().flatten().to_numpy().astype(np.int32)
        row = {"block": table.column("block")[:1].combine_chunks(), "n": pa.array([table.num_rows], pa.int32())}
        for column, made in (("ids", table.column("vec_id").to_numpy()), ("labels", table.column("label").to_numpy().astype(np.int64)), ("vectors", vectors)):
            row[column] = pa.array([made.tobytes()], pa.binary())
        return pa.table(row)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(blocks)).cast("int"))
    return stage(dealt.groupBy("block").applyInArrow(pack, "block int, n int, ids binary, labels binary, vectors binary"), name)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and vectors of a packed block."""
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(row["vectors"], np.int32).reshape(len(ids), -1)


def met(rows: DataFrame, n_rows: int, anchors: DataFrame, n_anchors: int, search, found: str) -> DataFrame:
    """What `search` finds in each block of rows for each block of anchors."""
    left = rows.withColumn("anchors", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
    right = anchors.withColumnRenamed("block", "anchors").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))

    def meet(one: pa.Table, other: pa.Table) -> pa.Table:
        made = {"anchors": [], "part": [], "finds": []}
        if one.num_rows and other.num_rows:
            row, anchor = one.to_pylist()[0], other.to_pylist()[0]
            made = {"anchors": [anchor["anchors"]], "part": [row["block"]], "finds": [search(opened(row), opened(anchor), anchor)]}
        give_back()
        return pa.table({"anchors": pa.array(made["anchors"], pa.int32()), "part": pa.array(made["part"], pa.int32()), "finds": pa.array(made["finds"], pa.binary())})

    finds = left.groupBy("block", "anchors").cogroup(right.groupBy("block", "anchors")).applyInArrow(meet, "anchors int, part int, finds binary")
    parts = n_rows
    while parts > 1:
        parts = -(-parts // MERGED)
        finds = merged(finds, found)
    return finds


#: A find: place of the anchor in its block, the positive's score that it goes with (0 for positives), id and score.
FIND = np.dtype([("anchor", np.int32), ("rival", np.int64), ("id", np.int64), ("score", np.int64)])


def merged(finds: DataFrame, found: str) -> DataFrame:
    """The best of `MERGED` blocks' finds of one block of anchors, for each anchor and rival."""
    most = POSITIVES if found == "positives" else NEGATIVES

    def merge(table: pa.Table) -> pa.Table:
        held = np.concatenate([np.frombuffer(x.as_buffer(), FIND) for x in table.column("finds")])
        return pa.table({"anchors": table.column("anchors")[:1].combine_chunks(), "part": table.column("part")[:1].combine_chunks(), "finds": pa.array([cut(held, most).tobytes()], pa.binary())})

    grouped = finds.withColumn("part", F.expr(f"part div {MERGED}").cast("int")).groupBy("anchors", "part")
    return grouped.applyInArrow(merge, "anchors int, part int, finds binary")


def cut(held: np.ndarray, most: int) -> np.ndarray:
    """The first of each anchor and rival, in order."""
    held = held[np.lexsort((held["id"], -held["score"], held["rival"], held["anchor"]))]
    if not len(held):
        return held
    starts = np.flatnonzero(np.concatenate([[True], (held["anchor"][1:] != held["anchor"][:-1]) | (held["rival"][1:] != held["rival"][:-1])]))
    rank = np.arange(len(held)) - np.repeat(starts, np.diff(np.append(starts, len(held))))
    return held[rank < most]


def finds_of(places: list[int], rivals: list[int], ids: list[np.ndarray], values: list[np.ndarray]) -> bytes:
    made = np.empty(sum(map(len, ids)), FIND)
    if len(made):
        sizes = [len(x) for x in ids]
        made["anchor"], made["rival"] = np.repeat(places, sizes), np.repeat(rivals, sizes)
        made["id"], made["score"] = np.concatenate(ids), np.concatenate(values)
    return made.tobytes()


def search_positives(rows: tuple, anchors: tuple, _: dict) -> bytes:
    (ids, labels, vectors), (own, own_labels, queries) = rows, anchors
    codes, (words, turns) = Codes(vectors), rotations(vectors.shape[1])
    places, held, values = [], [], []
    for i, (anchor, label, vector) in enumerate(zip(own, own_labels, queries, strict=True)):
        same = np.flatnonzero((labels == label) & (ids != anchor))
        near = survivors(Query(vector, words, turns), codes, same, best_of(POSITIVES))
        found = first(ids[near], scores(vectors[near], vector), POSITIVES)
        places.append(i)
        held.append(found[0])
        values.append(found[1])
    return finds_of(places, [0] * len(places), held, values)


def search_negatives(rows: tuple, anchors: tuple, packed_: dict) -> bytes:
    (ids, labels, vectors), (own, own_labels, queries) = rows, anchors
    codes, (words, turns) = Codes(vectors), rotations(vectors.shape[1])
    positives = np.frombuffer(packed_["finds"], FIND)
    places, rivals, held, values = [], [], [], []
    for i, (label, vector) in enumerate(zip(own_labels, queries, strict=True)):
        asked = sorted(set(positives["score"][positives["anchor"] == i].tolist()))
        bands = {score: band(score) for score in asked if band(score)[0] <= band(score)[1]}
        if not bands:
            continue
        others = np.flatnonzero(labels != label)
        near = survivors(Query(vector, words, turns), codes, others, within(list(bands.values()), NEGATIVES))
        exact = scores(vectors[near], vector)
        for score, (least, most) in bands.items():
            there = (exact >= least) & (exact <= most)
            found = first(ids[near][there], exact[there], NEGATIVES)
            places.append(i)
            rivals.append(score)
            held.append(found[0])
            values.append(found[1])
    return finds_of(places, rivals, held, values)


def mined(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str | Column = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. `is_anchor` and `label` may be expressions over the id and label columns."""
    spark = vectors.sparkSession
    ship_code(spark)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    of = F.col(label) if isinstance(label, str) else label
    rows = usable(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), of.cast("long").alias("label"), F.col(embedding).alias("vector")))
    rows = stage(rows.join(vectors.where(is_anchor).select(F.col(vec_id).cast("long").alias("vec_id")).distinct().withColumn("is_anchor", F.lit(True)), "vec_id", "left"), "negatives-rows")
    common = rows.groupBy(F.size("whole").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.count("is_anchor").alias("anchors")).orderBy(F.desc("n"), "length").first()
    if common is None or not common["anchors"]:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("whole") == common["length"])
    n_rows, n_anchors = -(-common["n"] // ROWS), -(-common["anchors"] // ANCHORS)
    blocks = packed(rows.drop("is_anchor"), n_rows, 3, "negatives-blocks")
    anchors = packed(rows.where("is_anchor").drop("is_anchor"), n_anchors, 4, "negatives-anchors")
    positives = stage(met(blocks, n_rows, anchors, n_anchors, search_positives, "positives"), "negatives-positives")
    asked = anchors.join(positives.select(F.col("anchors").alias("block"), "finds"), "block")
    negatives = met(blocks, n_rows, asked, n_anchors, search_negatives, "negatives")

    def listed(anchor: pa.Table, positive: pa.Table, negative: pa.Table) -> pa.Table:
        ids = np.frombuffer(anchor["ids"], np.int64)
        pairs, held = np.frombuffer(positive, FIND), np.frombuffer(negative, FIND)
        held = cut(held, NEGATIVES)
        by: dict[tuple[int, int], np.ndarray] = {}
        if len(held):
            starts = np.flatnonzero(np.concatenate([[True], (held["anchor"][1:] != held["anchor"][:-1]) | (held["rival"][1:] != held["rival"][:-1])]))
            by = {(int(x["anchor"][0]), int(x["rival"][0])): x for x in np.split(held, starts[1:])}
        made = [(pair, by[key]) for pair in pairs if (key := (int(pair["anchor"]), int(pair["score"]))) in by]
        sizes = [len(x) for _, x in made]
        columns = [
            np.repeat(np.array([ids[p["anchor"]] for p, _ in made], np.int64), sizes),
            np.repeat(np.array([p["id"] for p, _ in made], np.int64), sizes),
            np.concatenate([np.arange(1, n + 1, dtype=np.int32) for n in sizes] or [np.empty(0, np.int32)]),
            np.concatenate([x["id"] for _, x in made] or [np.empty(0, np.int64)]),
            np.repeat(np.array([p["score"] for p, _ in made], np.int64), sizes),
            np.concatenate([x["score"] for _, x in made] or [np.empty(0, np.int64)]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=[x.split(" ")[0] for x in schema.split(", ")])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield listed(row, row["finds"], row["negatives"])

    last = negatives.select(F.col("anchors").alias("block"), F.col("finds").alias("negatives"))
    return asked.select("block", "ids", "finds").join(last, "block").mapInArrow(unpacked, schema)
