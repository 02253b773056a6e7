"""Equi-join whose hot keys are measured first and spread over many tasks, on either side.

A summary of frequent items, which merges over tasks, names the keys with more than a
task's fair part of a side. Rows of such a key are dealt to cells by a unique column, and
the other side's rows of that key, and of no other, go to each of its cells. A key that is hot
on both sides gets a grid of cells. Which cell a row falls into follows from the row, so that
a task that is run again gives the same. Every other key is joined as ever, and adaptive execution is not needed.

Outer, semi and anti joins must know of an absence, which no single cell can tell: semi and anti
joins ask for distinct keys, so that a hot right side is one row per task before it is shuffled, and a
left join adds the left rows without partner by their key, not by their cell.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.operators.keyed import all_known

#: Cells that a task's fair part of a side is cut into: small ones even out.
CELLS_PER_TASK = 16
#: Items a summary keeps, and the keys it may name: so many and no more come to the driver.
TRACKED, NAMED = 10_000, 1_000

_HASH, _LEFT, _RIGHT = "__hash", "__left_cell", "__right_cell"


class Heavy(NamedTuple):
    """Hashes of a side's hot keys with the number of cells each gets."""

    cells: dict[int, int]

    def of(self, hashed: Column) -> Column:
        """Cells of a row's key, 1 if it is not hot."""
        if not self.cells:
            return F.lit(1)
        told = F.create_map(*[F.lit(v).cast("long" if i % 2 == 0 else "int") for i, v in enumerate(x for kv in self.cells.items() for x in kv)])
        return F.when(hashed.isin(*self.cells), F.element_at(told, hashed)).otherwise(F.lit(1))


def _hashed(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(rows: DataFrame, keys: list[str], tasks: int, cells_per_task: int = CELLS_PER_TASK) -> Heavy:
    """Keys with over half of a task's fair part of the rows. Unknown keys are never hot: they join nothing.

    The summary is an aggregate of one pass that holds `TRACKED` items per task; it never misses a key
    with more than one in a few thousand rows, and names at most `NAMED` keys.
    """
    known = rows.where(all_known(keys)).select(_hashed(keys).alias(_HASH))
    told = known.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k({_HASH}, {NAMED}, {TRACKED})").alias("top")).first()
    if not told["n"]:
        return Heavy({})
    part = told["n"] / tasks
    return Heavy({i["item"]: max(2, round(i["count"] * cells_per_task / part)) for i in told["top"] if i["item"] is not None and i["count"] > part / 2})


def _dealt(rows: DataFrame, keys: list[str], own: Heavy, other: Heavy, spread_by: str, own_cell: str, other_cell: str) -> DataFrame:
    """Rows with a cell of their own, and a copy for each cell of the other side."""
    hashed = rows.withColumn(_HASH, _hashed(keys))
    hashed = hashed.withColumn(own_cell, F.pmod(F.xxhash64(F.lit(1), spread_by), own.of(F.col(_HASH))).cast("int"))
    if not other.cells:
        return hashed.withColumn(other_cell, F.lit(0)).drop(_HASH)
    return hashed.withColumn(other_cell, F.explode(F.sequence(F.lit(0), other.of(F.col(_HASH)) - 1))).drop(_HASH)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, left_by: str, right_by: str | None = None, tasks: int | None = None) -> DataFrame:
    """`left.join(right, keys, how)` for `inner`, `left`, `left_semi` and `left_anti`.

    `left_by` and `right_by` name a column of each side that differs from row to row; repeated values cost balance,
    not rows. `tasks` is the number of partitions to balance over, by default that of the session's shuffles. Unknown keys match nothing.
    Column names other than the keys must differ between the sides. A right join is a left one with its sides changed.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"no {how} join here")
    spark = left.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_left = heavy_keys(left, keys, tasks)
    if how in ("left_semi", "left_anti"):
        known = right.where(all_known(keys)).select(*keys).distinct()
        if not hot_left.cells:
            return left.join(known, keys, how)
        asked = _dealt(left, keys, hot_left, Heavy({}), left_by, _LEFT, _RIGHT)
        given = _dealt(known, keys, Heavy({}), hot_left, keys[0], _RIGHT, _LEFT)
        return asked.join(given, [*keys, _LEFT, _RIGHT], how).select(*left.columns)
    if right_by is None:
        raise ValueError("right_by is needed where right rows are joined")
    hot_right = heavy_keys(right, keys, tasks)
    out = [*left.columns, *[c for c in right.columns if c not in keys]]
    if not hot_left.cells and not hot_right.cells:
        return left.join(right, keys, how).select(*out)
    theirs = _dealt(right.where(all_known(keys)), keys, hot_right, hot_left, right_by, _RIGHT, _LEFT)

    def met(rows: DataFrame, kind: str) -> DataFrame:
        return _dealt(rows, keys, hot_left, hot_right, left_by, _LEFT, _RIGHT).join(theirs, [*keys, _LEFT, _RIGHT], kind).select(*out)

    if how == "inner" or not hot_right.cells:
        return met(left, how)
    # A left row of a key that is hot on the right is copied: whether it has no partner is asked by its key.
    copied = F.coalesce(all_known(keys) & _hashed(keys).isin(*hot_right.cells), F.lit(False))
    alone = skew_join(left.where(copied), right.where(copied), keys, "left_anti", left_by, tasks=tasks)
    return (
        met(left.where(~copied), "left")
        .unionByName(met(left.where(copied), "inner"))
        .unionByName(alone, allowMissingColumns=True)
        .select(*out)
    )
