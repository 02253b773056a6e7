"""Running sums, minima and maxima per key that hold up when keys are huge.

A window puts all rows of a key into one task. Keys with more rows than a block
may have are counted first; their rows, however many such keys there are, are
put in the order of key and order column over range partitions, whose bounds
follow the rows themselves and not the values. Each partition's part of a key is
a block, or is cut into blocks by its rows' ranks, so that small blocks need no
more partitions than their rows do. Each block is a window of its own; what the
earlier blocks of the key add up to is worked out on one row per block and
added. The result is that of the plain window. The rows of blocks are many where
keys are narrowed further, so they are merged with those of the key, whose order
they have, and never broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldsync.sources.staging import stage

BLOCK_ROWS = 2_000_000

#: Rows of a range partition, unless a block has more. Every partition costs tasks, and samples sent to the driver.
PARTITION_ROWS = 250_000

_AGGREGATE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    how: str
    value: Column


def _combine(how: str, carried: Column, local: Column) -> Column:
    if how == "sum":
        return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)
    return F.least(carried, local) if how == "min" else F.greatest(carried, local)


@dataclass(frozen=True)
class Blocks:
    """Which keys are huge (none if None), over how many range partitions their rows go, and how many of these rows a
    block may have (0: all that a partition has of a key)."""

    keys: tuple[str, ...]
    order: str
    huge: DataFrame | None
    partitions: int
    rows: int = 0

    def cut(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of usual keys, and those of huge keys with their block."""
        huge = rows.join(self.huge, list(self.keys), "left_semi").repartitionByRange(self.partitions, *self.keys, self.order)
        huge = huge.withColumn("_block", F.spark_partition_id().cast("long"))
        if self.rows:
            # Rows of equal order have one rank, so they stay together.
            rank = F.rank().over(Window.partitionBy(*self.keys, "_block").orderBy(self.order)).cast("long")
            within = F.floor((rank - 1) / F.lit(self.rows)).cast("long")
            huge = huge.withColumn("_within", within).withColumn("_block", F.shiftleft("_block", 32) + F.col("_within")).drop("_within")
        usual = rows.join(self.huge, list(self.keys), "left_anti")
        return usual, stage(huge, "blocks")

    def running(
        self,
        rows: DataFrame,
        measures: dict[str, Measure],
        also_by: tuple[str, ...] = (),
        before: bool = False,
    ) -> DataFrame:
        """Add each measure over the rows of the key up to, or strictly before, a row.

        `also_by` narrows the key further. Key columns must not be NULL. Rows
        of equal order always lie in the same block.
        """
        by = [*self.keys, *also_by]
        last = -1 if before else 0

        def window(*keys: str) -> list[Column]:
            frame = Window.partitionBy(*keys).orderBy(self.order).rangeBetween(Window.unboundedPreceding, last)
            return [_AGGREGATE[m.how](m.value).over(frame).alias(n) for n, m in measures.items()]

        if self.huge is None:
            return rows.select("*", *window(*by))
        usual, huge = self.cut(rows)
        local = huge.select("*", *window(*by, "_block"))
        per_block = huge.groupBy(*by, "_block").agg(
            *[_AGGREGATE[m.how](m.value).alias(f"_{n}") for n, m in measures.items()]
        )
        earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        carried = per_block.select(
            *by, "_block", *[_AGGREGATE[m.how](f"_{n}").over(earlier).alias(f"_{n}") for n, m in measures.items()]
        )
        kept = [F.col(c) for c in rows.columns]
        joined = local.join(carried.hint("merge"), [*by, "_block"], "left").select(
            *kept, *[_combine(m.how, F.col(f"_{n}"), F.col(n)).alias(n) for n, m in measures.items()]
        )
        return usual.select("*", *window(*by)).unionByName(joined)


def plan_blocks(rows: DataFrame, keys: list[str], order: str, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Count the rows of each key; one number comes to the driver.

    Blocks are about half of what a key may have: range partitions because their bounds are sampled, blocks within them by rank.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    # No key of a table of that many rows at most can have more: its keys need not be counted.
    total = counted.agg(F.sum("_n")).first()[0] if rows.count() > block_rows else None
    if total is None:
        return Blocks(tuple(keys), order, None, 0)
    blocks = -(-2 * total // block_rows)
    partitions = min(blocks, max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // PARTITION_ROWS)))
    huge = stage(counted.select(*keys), "huge-keys")
    return Blocks(tuple(keys), order, huge, partitions, max(1, block_rows // 2) if partitions < blocks else 0)
