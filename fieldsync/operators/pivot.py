"""Property lists to wide attributes.

A response carries its whole property list, so the attributes are taken inside
the row: no explode, no shuffle, and a row of any width stays one row.
`wide_by_key` is the form for properties that lie in rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mapping = dict[str, tuple[str, tuple[int, ...]]]


def _compared(value: Column, collation: str) -> Column:
    """What texts are compared by: the collation, then the bytes, so that equal ones don't depend on their order."""
    return F.when(value.isNotNull(), F.struct(F.collate(value, collation).alias("by"), value.alias("text")))


def attribute(properties: Column, member: str, ids: tuple, id_field: str = "id", collation: str | None = None) -> Column:
    """Greatest non-NULL value of `member` among the properties with one of the ids, by bytes or by a collation."""
    wanted = F.filter(properties, lambda p: p[id_field].isin(*ids))
    if collation is None:
        return F.array_max(F.transform(wanted, lambda p: p[member]))
    return F.array_max(F.transform(wanted, lambda p: _compared(p[member], collation)))["text"]


def wide(properties: Column, mapping: Mapping, id_field: str = "id", collation: str | None = None) -> list[Column]:
    return [attribute(properties, member, ids, id_field, collation).alias(name) for name, (member, ids) in mapping.items()]


def wide_by_key(
    rows: DataFrame, keys: list[str], id_column: str, mapping: dict[str, tuple[str, tuple]], collation: str | None = None
) -> DataFrame:
    """Conditional maxima per key. Partial maxima are formed before the shuffle. `collation` is for text columns."""

    def greatest(column: str, ids: tuple) -> Column:
        value = F.when(F.col(id_column).isin(*ids), F.col(column))
        return F.max(value) if collation is None else F.max(_compared(value, collation))["text"]

    return rows.groupBy(*keys).agg(*[greatest(column, ids).alias(name) for name, (column, ids) in mapping.items()])
