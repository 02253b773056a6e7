"""SimHash near-duplicates found with vantage-point trees.

The fingerprint of a text has a bit set where more than half of its shingles' hashes have it. Fingerprints
at `distance` or fewer differing bits are linked.

Different fingerprints only are searched. Two that differ in at most three bits differ in at most one bit
in their upper or in their lower half, so each half is searched in a tree of its own for that radius, which
prunes far better than the whole; the pairs found are then checked on all bits. The top of a tree is built
on a bounded sample: each node has a vantage point and a radius, fingerprints at most that far from it go
inside, others outside. Its leaves are shards. A fingerprint is a member of the one shard it falls into and
visits each shard that the triangle inequality can't rule out, so every link is seen. A shard with too many
members is split by a hash of the whole fingerprint, and its visitors come to each part. Within a part the
tree goes on over the part's members, down to small leaves where distances are taken; where all halves are
equal it goes on over the whole fingerprints. A part returns links that connect what it has linked, never
all pairs. Components are found over the links with alternating large and small stars.

A null or empty text has fingerprint zero, which is linked like any other. A null `doc_id` gives no
component its name; a component of such rows alone has a null one. Repeated rows share a fingerprint. An
empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsync.llm.batches import each_text, give_back, ship_code
from fieldsync.sources.staging import stage

#: Words of a shingle, seed of its hash, bits that may differ.
SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Members of a shard, about; sampled fingerprints per shard; shards of a tree at most (beyond it shards grow and are split into parts).
SHARD, SAMPLED, SHARDS = 20_000, 32, 4_096
#: Members of a part at most, about.
PART = 60_000
#: Members of a tree's leaf within a task; distances taken at once.
LEAF, AT_ONCE = 96, 1 << 20

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a text in UTF-8, as an unsigned number."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    joined = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter((digest(s, SEED) for s in joined), np.uint64, n).view(np.uint8).reshape(n, 8)
    counts = np.concatenate([np.bincount(hashes[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a signed 64-bit number."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint_of(t.encode(), shingle) for t in each_text(texts)]
            yield pa.array(np.array(found, np.uint64).view(np.int64))
        give_back()

    return of(text)


def hexadecimal(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distances(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Top:
    """The upper levels of a tree over one half of the fingerprints: vantage points and radii, in heap order. Leaves are shards."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth = depth
        self.points, self.radii = np.zeros(2**depth - 1, np.uint32), np.full(2**depth - 1, -1, np.int64)
        here = {0: sample}
        for node in range(2**depth - 1):
            rows = here.pop(node)
            inside, outside = rows, rows[:0]
            if len(np.unique(rows)) > 1:
                point, radius = vantage(rows, np.random.default_rng(node))
                self.points[node], self.radii[node] = point, radius
                near = distances(rows, point) <= radius
                inside, outside = rows[near], rows[~near]
            here[2 * node + 1], here[2 * node + 2] = inside, outside

    def shards(self, halves: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and shards: the shard of each row (reach 0), or all that may hold something within reach."""
        rows, nodes = np.arange(len(halves)), np.zeros(len(halves), np.int64)
        for _ in range(self.depth):
            d, radius = distances(halves[rows], self.points[nodes]), self.radii[nodes]
            flat = radius < 0  # nothing to tell rows apart: all go inside
            inside, outside = flat | (d - reach <= radius), ~flat & (d + reach > radius)
            rows, nodes = np.concatenate([rows[inside], rows[outside]]), np.concatenate([2 * nodes[inside] + 1, 2 * nodes[outside] + 2])
        return rows, nodes - (2**self.depth - 1)


def vantage(rows: np.ndarray, random: np.random.Generator) -> tuple[np.generic, int]:
    """Of a few points the one whose median radius has fewest rows near its border for what it divides."""
    best = None
    some = rows if len(rows) <= 512 else rows[random.integers(0, len(rows), 512)]
    for point in rows[random.integers(0, len(rows), 6)]:
        counts = np.bincount(distances(some, point), minlength=66)
        below = np.cumsum(counts)
        for radius in range(65):
            inside = below[radius]
            if 0 < inside < len(some):
                border = counts[radius] + counts[radius + 1]
                balance = min(inside, len(some) - inside) / len(some)
                score = (1 + border / len(some)) ** 1.0 / max(balance, 1e-9) ** 0.7
                if best is None or score < best[0]:
                    best = (score, point, radius)
    if best is None:
        values = np.unique(rows)
        return values[0], 0
    return best[1], best[2]


class Forest:
    """Which of n rows are connected, and the links that connected them."""

    def __init__(self, n: int):
        self.group, self.kept = np.arange(n), []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Keep of these links those that connect something new."""
        x, y = self.group[a], self.group[b]
        new = np.flatnonzero(x != y)
        if not len(new):
            return
        _, first = np.unique(np.minimum(x[new], y[new]) << 32 | np.maximum(x[new], y[new]), return_index=True)
        new = new[first]
        parent: dict[int, int] = {}

        def root(i: int) -> int:
            top = i
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(i, i)) != top:
                parent[i], i = top, up
            return top

        for i, p, q in zip(new.tolist(), x[new].tolist(), y[new].tolist(), strict=True):
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
                self.kept.append((int(a[i]), int(b[i])))
        to = np.arange(len(self.group))
        old = np.fromiter(parent, np.int64, len(parent))
        to[old] = [root(i) for i in old.tolist()]
        self.group = to[self.group]


def linked(fingerprints: np.ndarray, members: np.ndarray, shift: int, distance: int) -> list[tuple[int, int]]:
    """Links that connect all rows which a link to a member (as places) connects: at `distance` or fewer bits, one at most in the half at `shift`."""
    half = (fingerprints >> np.uint64(shift)).astype(np.uint32)
    random, forest = np.random.default_rng(1), Forest(len(fingerprints))
    stack = [(members, np.arange(len(fingerprints)), True)]
    while stack:
        m, q, by_half = stack.pop()
        if not len(m) or not len(q):
            continue
        points, reach = (half, distance // 2) if by_half else (fingerprints, distance)
        rows = points[m]
        if len(m) > LEAF and (rows != rows[0]).any():
            point, radius = vantage(rows, random)
            near = distances(rows, point) <= radius
            if near.any() and not near.all():
                d = distances(points[q], point)
                stack.append((m[near], q[d - reach <= radius], by_half))
                stack.append((m[~near], q[d + reach > radius], by_half))
                continue
        if len(m) > LEAF and by_half:  # equal halves: go on over the whole
            stack.append((m, q, False))
            continue
        step = max(1, AT_ONCE // len(m))
        for a in range(0, len(q), step):
            some = q[a : a + step]
            x, y = np.nonzero(np.bitwise_count(fingerprints[some][:, None] ^ fingerprints[m][None, :]) <= distance)
            forest.add(some[x], m[y])
    return forest.kept


def links(points: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b: the ids of two fingerprints) that connect all fingerprints at `distance` or fewer bits. `points`: id, fingerprint, each different."""
    spark = points.sparkSession
    if not 1 <= distance <= 3:
        raise ValueError("two halves are searched for one differing bit: a distance of 1, 2 or 3")
    n = points.count()
    depth = int(np.clip(np.ceil(np.log2(max(1, n / SHARD))), 0, np.log2(SHARDS)))
    wanted = SAMPLED * 2**depth
    sample = points.select("fingerprint").sample(min(1.0, 1.2 * wanted / max(1, n)), seed=11).limit(2 * wanted).toPandas()["fingerprint"].to_numpy(np.int64).view(np.uint64)
    tops = {shift: Top((sample >> np.uint64(shift)).astype(np.uint32), depth) for shift in (0, 32)}

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shard of each fingerprint in either tree."""
        for batch in batches:
            f = batch.column(1).to_numpy().view(np.uint64)
            own = []
            for shift, top in tops.items():
                rows, shards = top.shards((f >> np.uint64(shift)).astype(np.uint32), 0)
                out = np.empty(len(f), np.int64)
                out[rows] = shards
                own.append(out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own[0], pa.int32()), pa.array(own[1], pa.int32())], names=["id", "fingerprint", "low", "high"])

    at = stage(points.select("id", "fingerprint").mapInArrow(members, "id long, fingerprint long, low int, high int"), "vptree-members")
    sizes = {}
    for shift, column in ((0, "low"), (32, "high")):
        counts = np.ones(2**depth, np.int64)
        for row in at.groupBy(column).count().collect():  # at most one row per shard
            counts[row[0]] = -(-row["count"] // PART)
        sizes[shift] = counts

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each fingerprint as member of its part, and as visitor of parts that may hold something near."""
        for batch in batches:
            ids, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for k, (shift, top) in enumerate(tops.items()):
                home, parts = batch.column(2 + k).to_numpy().astype(np.int64), sizes[shift]
                rows, shards = top.shards((f >> np.uint64(shift)).astype(np.uint32), distance // 2)
                times = parts[shards]
                rows, shards = np.repeat(rows, times), np.repeat(shards, times)
                part = np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
                mine = (f[rows] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[shards] == part
                member = (shards == home[rows]) & mine
                for i in range(0, len(rows), 50_000):
                    s = slice(i, i + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows[s]), k), pa.int32()), pa.array(shards[s], pa.int32()), pa.array(part[s], pa.int32()), pa.array(member[s]), pa.array(ids[rows[s]]), pa.array(f[rows[s]].view(np.int64))],
                        names=["tree", "shard", "part", "member", "id", "fingerprint"],
                    )

    def search(table: pa.Table) -> pa.Table:
        shift = 32 * table.column("tree")[0].as_py()
        member = table.column("member").to_numpy()
        ids, f = table.column("id").to_numpy(), table.column("fingerprint").to_numpy().view(np.uint64)
        kept = np.array(linked(f, np.flatnonzero(member), shift, distance), np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(ids[kept[:, 0]], pa.int64()), "b": pa.array(ids[kept[:, 1]], pa.int64())})

    sent = at.mapInArrow(visits, "tree int, shard int, part int, member boolean, id long, fingerprint long")
    ship_code(spark)
    return sent.groupBy("tree", "shard", "part").applyInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """id and component (the least id reachable) of all ids of links a-b, by alternating large and small stars."""
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        # large star: each id links its larger neighbours to the least of its neighbourhood
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        # small star: each id links itself and its smaller neighbours to the least of them
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).union(low).where("a <> b").distinct()
        edges = stage(small, "stars")
        seen = edges.agg(F.count(F.lit(1)), F.sum("a"), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
        state = seen


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, a hash of the text, fingerprint (signed) and component_id (the least doc_id reachable) of each row."""
    ship_code(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.hash(F.col(text)).alias("text_hash"), fingerprints(F.col(text), shingle).alias("fingerprint"))
    rows = stage(rows, "fingerprints")
    # one point per fingerprint; those of rows without any doc_id get names below all ids
    points = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    points = stage(points, "points")
    unnamed = points.where("least IS NULL").limit(1).count() > 0
    if unnamed:  # a fingerprint as its own name might meet a doc_id: number all points instead
        points = stage(points.select("fingerprint", "least", F.monotonically_increasing_id().alias("id")), "points")
    else:
        points = points.withColumn("id", F.col("least"))
    found = components(links(points.select("id", "fingerprint"), distance))
    named = points.join(found, "id", "left")
    if unnamed:
        least = named.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("name"))
        named = named.join(least, "component", "left").withColumn("component", F.coalesce("name", "least"))
    else:
        named = named.withColumn("component", F.coalesce("component", "least"))
    classes = named.select(F.col("fingerprint"), F.col("component").alias("component_id"))
    return rows.join(classes, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """`docs` with one row of each component: that of the least doc_id. Rows without any id stay once per fingerprint."""
    found = near_duplicates(docs, doc_id, text, shingle, distance)
    component = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("f"), F.col("fingerprint").cast("string")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")))
    kept = found.groupBy(component).agg(first.alias("first")).select("first.__id", "first.__hash")
    rows = docs.withColumns({"__id2": F.col(doc_id).cast("long"), "__hash2": F.hash(F.col(text))})
    rows = rows.join(kept, F.col("__id2").eqNullSafe(F.col("__id")) & (F.col("__hash2") == F.col("__hash")), "left_semi")
    # of rows that repeat an id and its text, one
    once = Window.partitionBy("__id2", "__hash2").orderBy(F.lit(0))
    return rows.withColumn("__row", F.row_number().over(once)).where("__row = 1").select(*docs.columns)
