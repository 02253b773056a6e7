"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fieldsync.session import lacking

#: Writer options for rows that may be megabytes long. A writer holds a row group at once, and a reader unpacks up to 4096
#: rows of it. Its size is that of compressed pages and of the page begun: as pages are no smaller here, long rows
#: count as they are, whatever the codec makes of them. By default the size is looked at after 100 rows.
LONG_ROWS = {
    "compression": "zstd",
    "parquet.block.size": 16 << 20,
    "parquet.page.size": 32 << 20,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 4,
}

_local_roots: dict[str, str] = {}
_scopes: list[tuple[str, str]] = []
_warned: set[str] = set()


def staging_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only a local session may go without, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="fieldsync-")
    return _local_roots[application]


@contextmanager
def staging(spark: SparkSession, root: str | None = None) -> Iterator[str]:
    """Where jobs within stage their tables: a folder of its own, under `root` or the session's, that is deleted at the end.

        with staging(spark):
            append_run(install_push(inputs)["delta"], ...)

    Results must be written before it ends. Scopes are of the driver's thread of work; they may nest.
    """
    folder = f"{root or staging_root(spark)}/{spark.sparkContext.applicationId}/scope-{uuid.uuid4().hex}"
    scope = (spark.sparkContext.applicationId, folder)
    _scopes.append(scope)
    try:
        yield folder
    finally:
        _scopes.remove(scope)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, **options: int | str) -> DataFrame:
    """Write the rows, with the writer's options if any, and read them back.

    Cuts the lineage at a table that outlives the loss of executors, and makes
    a result that is used more than once be computed once.
    """
    spark = df.sparkSession
    application = spark.sparkContext.applicationId
    if application not in _warned:
        _warned.add(application)
        if missing := lacking(spark):
            warnings.warn(f"jobs are tuned for {missing}: hot keys on a join's side may stay in one task", stacklevel=2)
    folder = next((f for a, f in reversed(_scopes) if a == application), None) or f"{staging_root(spark)}/{application}"
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
