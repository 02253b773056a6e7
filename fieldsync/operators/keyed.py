"""Keyed building blocks: first, latest, lookup, anti-join.

Each is a hash aggregate that combines before the shuffle, plus an equi-join.
A key with very many rows therefore costs one partial row per task, and no row
is ever sorted or gathered by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a key table up to which Spark may broadcast it.
FEW_ROWS = 100_000


def merged_if_many(rows: DataFrame) -> DataFrame:
    """A staged side of a join that is merged, not broadcast through the driver, if it has many rows.

    Spark goes by the size of the files, and those of keys are many times smaller than their rows.
    """
    return rows.hint("merge") if rows.count() > FEW_ROWS else rows


def all_known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def first_orders(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The lowest `order` per key, as one column; every row with a NULL key is a key of its own."""
    alone = F.when(~all_known(keys), F.col(order)).alias("_alone")
    return rows.groupBy(*keys, alone).agg(F.min(order).alias(order)).select(order)


def first_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Row with the lowest `order` per key; a row with a NULL key always stays.

    `order` must be unique: the chosen rows are found again by it, so the join
    spreads evenly however the keys are distributed.
    """
    return rows.join(first_orders(rows, keys, order), order, "left_semi")


def latest_per_key(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """The columns of the row with the highest `order` per key.

    One aggregate per column keeps the state in fixed-width buffers, so that it
    is a hash aggregate; a struct as state would make it a sort.
    """
    return rows.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in columns])


def lowest_id(rows: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """One row per natural key with its lowest id. NULL keys can never be looked up."""
    return rows.where(all_known(keys)).groupBy(*keys).agg(F.min(id_column).alias(id_column))


def absent(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not known. A NULL key matches nothing, so it is absent.

    The known keys are made distinct first: a key that is known a great many
    times is then one row per task before it is shuffled.
    """
    return rows.join(known.select(*keys).distinct(), keys, "left_anti")


def present(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is known, without copies."""
    return rows.join(known.select(*keys).distinct(), keys, "left_semi")


def new_first_per_key(rows: DataFrame, known: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Insert-if-absent over a batch: unknown keys only, and the first row of each."""
    return first_per_key(absent(rows, known, keys), keys, order)


def highest(rows: DataFrame, id_column: str) -> int:
    """Highest id, 0 for an empty table. One number comes to the driver."""
    value = rows.agg(F.max(id_column).alias("m")).first()["m"]
    return 0 if value is None else int(value)
