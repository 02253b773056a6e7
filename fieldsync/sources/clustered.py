"""Tables laid out by key in files of about equal size, and reads of a few keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a file, about: range bounds are sampled.
FILE_ROWS = 1_000_000
#: Keys that a read may name in its filter; beyond, they are joined.
POINT_KEYS = 1_000


def write_clustered(rows: DataFrame, path: str, keys: Sequence[str], n_rows: int, lookups: Sequence[str] = (), file_rows: int = FILE_ROWS) -> None:
    """Write rows in ranges of the keys, sorted by them, so that statistics tell which files and row groups hold a key.

    A last key that is unique keeps frequent values of the others from making one large file. Columns of
    `lookups` get Bloom filters, which tell it for single values where ranges don't.
    """
    writer = rows.repartitionByRange(max(1, -(-n_rows // file_rows)), *keys).sortWithinPartitions(*keys).write
    for column in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(min(n_rows, file_rows) or 1))
    writer.parquet(path)


def point_scan(rows: DataFrame, wanted: DataFrame, key: str, at_most: int = POINT_KEYS) -> DataFrame:
    """Rows whose key is among the wanted ones. Few keys go into the scan's filter, more are joined.

    `wanted` is read twice when there are more, so it should be a staged table. Unknown keys match nothing.
    """
    keys = wanted.select(key).where(F.col(key).isNotNull()).distinct()
    few = [row[0] for row in keys.limit(at_most + 1).collect()]
    return rows.where(F.col(key).isin(few)) if len(few) <= at_most else rows.join(keys, key, "left_semi")
