"""The most frequent values of a table of counts, as many as fit a bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def threshold(counts: DataFrame, n: str, most: int) -> int:
    """A power of two: at most `most` rows have a count of at least that. One row per power comes to the driver."""
    power = F.length(F.bin(F.col(n))) - 1
    held = sorted(((r["power"], r["count"]) for r in counts.where(F.col(n) > 0).groupBy(power.alias("power")).count().collect()), reverse=True)
    rows = 0
    for power_, count in held:
        rows += count
        if rows > most:
            return 1 << (power_ + 1)
    return 1
