"""Current rows and their history: the newest event of a key replaces, the rest move."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.sources.staging import stage


def replace_current(
    current: DataFrame, events: DataFrame, key: str, order: str, attributes: list[str]
) -> dict[str, DataFrame]:
    """New current rows and the rows that were displaced.

    `order` is unique over the events. Which event is the newest is settled on
    (key, order) alone; the wide rows are then taken apart by `order`, which
    spreads evenly. Events with a NULL key displace nothing and stay current.
    """
    keyed = events.where(F.col(key).isNotNull())
    newest = stage(keyed.select(key, order).groupBy(key).agg(F.max(order).alias(order)), "newest-events")

    columns = [key, *attributes]
    replacing = keyed.join(newest.select(order), order, "left_semi").select(*columns)
    unkeyed = events.where(F.col(key).isNull()).select(*columns)
    untouched = current.join(newest.select(key), key, "left_anti").select(*columns)

    displaced = current.join(newest.select(key), key, "left_semi").select(*columns)
    superseded = keyed.join(newest.select(order), order, "left_anti").select(*columns)
    return {
        "current": untouched.unionByName(replacing).unionByName(unkeyed),
        "history": displaced.unionByName(superseded),
    }
