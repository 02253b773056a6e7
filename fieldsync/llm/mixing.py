"""Mixing sources to target weights by Pfair scheduling.

Time is cut into slots; a slot takes one block, `BLOCK` bytes of one source. A source with weight w out of W,
the sum of all weights, is due w blocks in W slots: its k-th block (from 0) is released at floor(k * W / w) and
due by ceil((k + 1) * W / w). In every slot the released block with the earliest deadline runs; ties go by the
source's name. As the weights add up to W, every block meets its deadline, so that after any number of slots
each source has had its share, by the weights as given, to within less than one block. Every block that exists
is taken once in `placed`, which goes from block to block and so skips slots in which nothing is released.
A source that is not among the weights, or has less than 1 there, has the weight 1.

A source's documents are put in the order of a hash of their id. Where each begins, in bytes, says which
block it belongs to; a document longer than a block takes up the next ones too. Offsets are added up in two
steps, over ranges of the hash and within each, so that no source is ever in one task. When a source runs out,
the others go on in proportion. Nothing is dropped or repeated. The blocks' slots (about 4,000 a GB, numbers only)
are worked out in one task; rows and texts never are.

Built from DataFrame functions only. A null source counts as ''. A null or empty text is one byte long. A
null `doc_id` is a value like others; rows that repeat one follow each other. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of a block; rows of a range of the hash, about.
BLOCK, RANGE = 1 << 18, 20_000
#: Blocks that are worked out before they are added to the list of all.
STRETCH = 500

_SOURCE, _ORDER, _SIZE, _RANGE, _BEFORE = "__source", "__order", "__size", "__range", "__before"


def tempered_weights(docs: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """Target weights (source, weight) in proportion to the square root of each source's bytes."""
    sizes = docs.groupBy(F.coalesce(F.col(source), F.lit("")).alias("source")).agg(F.sum(sized(text)).alias("size"))
    return sizes.select("source", F.floor(F.sqrt(F.col("size").cast("double"))).cast("long").alias("weight"))


def sized(text: str):
    return F.greatest(F.lit(1), F.coalesce(F.octet_length(F.col(text)), F.lit(0))).cast("long")


def completed(weights: DataFrame, sizes: DataFrame) -> DataFrame:
    """source, weight, size (bytes) of all sources that are listed in `weights` or lie in `sizes`."""
    given = weights.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum("weight").cast("long").alias("weight"))
    weight = F.greatest(F.lit(1), F.coalesce("weight", F.lit(1))).cast("long")
    return sizes.join(given, "source", "full").select("source", weight.alias("weight"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))


def placed(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """source, weight, total of all weights, block and slot of every block of the sources in `sizes` (source, weight, size)."""
    listed = sizes.select("source", "weight", F.expr(f"(size + {block - 1}L) div {block}L").alias("n"))
    listed = listed.agg(F.sort_array(F.collect_list(F.struct("source", "weight", "n"))).alias("list"), F.sum("weight").alias("total"), F.sum("n").alias("blocks"))
    earliest = """array_min(transform(list, (x, i) -> IF(so_far.next[i] < x.n, struct(
        greatest(so_far.next[i] * total div x.weight, so_far.t) AS slot,
        ((so_far.next[i] + 1) * total + x.weight - 1) div x.weight AS deadline,
        i AS source, so_far.next[i] AS block), NULL)))"""
    stretch = f"""aggregate(sequence(1L, least({STRETCH}L, blocks - {STRETCH}L * part)),
        struct(all.next AS next, all.t AS t, CAST(array() AS array<struct<source:int,block:bigint,slot:bigint>>) AS ran),
        (so_far, step) -> transform(array({earliest}), b -> struct(
            transform(so_far.next, (n, i) -> IF(i = b.source, n + 1L, n)) AS next,
            b.slot + 1L AS t,
            concat(so_far.ran, array(struct(b.source AS source, b.block AS block, b.slot AS slot))) AS ran))[0])"""
    run = F.expr(
        f"""aggregate(sequence(0L, (blocks - 1L) div {STRETCH}L),
            struct(transform(list, x -> 0L) AS next, 0L AS t, CAST(array() AS array<struct<source:int,block:bigint,slot:bigint>>) AS ran),
            (all, part) -> transform(array({stretch}), s -> struct(s.next AS next, s.t AS t, concat(all.ran, s.ran) AS ran))[0],
            all -> all.ran)"""
    )
    ran = listed.where("blocks > 0").select("list", "total", F.explode(run).alias("x"))
    return ran.select(F.expr("list[x.source].source").alias("source"), F.expr("list[x.source].weight").alias("weight"), "total", "x.block", "x.slot")


def scheduled(
    docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK, out: str = "mix"
) -> DataFrame:
    """`docs` with a column `out`: block (of its source), release, deadline and slot of the block, place (byte at which the document begins in the block)."""
    n = docs.count()
    digits = max(1, math.ceil(math.log(max(1, n / RANGE), 16)))
    hashed = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.withColumns({_SOURCE: F.coalesce(F.col(source), F.lit("")), _ORDER: hashed, _SIZE: sized(text), _RANGE: F.substring(hashed, 1, digits)})
    ranges = rows.groupBy(_SOURCE, _RANGE).agg(F.sum(_SIZE).alias("size"))
    sizes = ranges.groupBy(F.col(_SOURCE).alias("source")).agg(F.sum("size").alias("size"))
    earlier = Window.partitionBy(_SOURCE).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(_SOURCE, _RANGE, "size", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(_BEFORE))
    touched = F.sequence(F.expr(f"{_BEFORE} div {block}L"), F.expr(f"({_BEFORE} + size - 1) div {block}L"))
    sizes, ranges = completed(weights, sizes), ranges.select(_SOURCE, _RANGE, _BEFORE, F.explode(touched).alias("block"))
    ranges = ranges.join(placed(sizes, block).withColumnRenamed("source", _SOURCE), [_SOURCE, "block"])
    # each range carries the slots of the blocks it touches, from its first one on
    ranges = ranges.groupBy(_SOURCE, _RANGE, _BEFORE, "weight", "total").agg(F.transform(F.sort_array(F.collect_list(F.struct("block", "slot"))), lambda x: x["slot"]).alias("slots"))
    within = Window.partitionBy(_SOURCE, _RANGE).orderBy(F.col(_ORDER), F.col(doc_id), F.md5(F.col(text))).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__within", F.coalesce(F.sum(_SIZE).over(within), F.lit(0)))
    rows = rows.join(ranges, [_SOURCE, _RANGE])
    begins = f"({_BEFORE} + __within)"
    number = f"({begins} div {block}L)"
    mix = F.expr(
        f"""struct({number} AS block,
            {number} * total div weight AS release,
            (({number} + 1) * total + weight - 1) div weight AS deadline,
            slots[CAST({number} - {_BEFORE} div {block}L AS int)] AS slot,
            {begins} % {block}L AS place)"""
    )
    return rows.withColumn(out, mix).drop(_SOURCE, _ORDER, _SIZE, _RANGE, _BEFORE, "__within", "weight", "total", "slots")


def interleaved(docs: DataFrame, weights: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK) -> DataFrame:
    """`docs` in the order of their slots, over partitions and within each."""
    made = scheduled(docs, weights, doc_id, source, text, block, "__mix")
    order = [F.col("__mix.slot"), F.col("__mix.place"), F.col(doc_id)]
    return made.repartitionByRange(*order).sortWithinPartitions(*order).select(*docs.columns)
