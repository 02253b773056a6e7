"""Small column expressions shared by the jobs. All stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wide enough for any sum; what may be added at once is narrower.
QUANTITY = "decimal(28,4)"
#: A movement's quantity has six digits before the point at most. A fixed value.
QUANTITY_LIMIT = 1_000_000


def concat_skip_null(*parts: Column) -> Column:
    """Concatenate, leaving NULL parts out."""
    return F.concat_ws("", *parts)


def or_blank(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def spaced_name(first: Column, last: Column) -> Column:
    return F.concat(or_blank(first), F.lit(" "), or_blank(last))


def date_of_text(day: Column, time: Column) -> Column:
    """Date of a `DD/MM/YYYY` text and a `HH24:MI:SS` text; single digits are fine."""
    return F.to_date(F.try_to_timestamp(F.concat(day, F.lit(" "), time), F.lit("d/M/yyyy H:m:s")))


def decode(col: Column, pairs: Iterable[tuple[int | tuple[int, ...], str]]) -> Column:
    """Text for a code, NULL when the code is in no pair."""
    out = F.lit(None).cast("string")
    for codes, text in pairs:
        codes = codes if isinstance(codes, tuple) else (codes,)
        out = F.when(col.isin(*codes), F.lit(text)).otherwise(out)
    return out


def quantity(col: Column) -> Column:
    return col.cast(QUANTITY)


def out_of_range(col: Column) -> Column:
    """Whether a quantity is more than a movement may have; NULL is not."""
    return F.coalesce(F.abs(col.cast("decimal(28,4)")) >= QUANTITY_LIMIT, F.lit(False))


def differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """Any pair is unequal. A NULL on either side is not a difference by itself."""
    out = None
    for old, new in pairs:
        out = (old != new) if out is None else out | (old != new)
    return out


def true_false(col: Column) -> Column:
    return F.when(col, F.lit("true")).otherwise(F.lit("false"))
