"""Versioned state tables: every run writes a fresh version, then claims its number."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldsync.schemas import schema
from fieldsync.sources import runlog
from fieldsync.sources.state import Superseded


def current_version(spark: SparkSession, root: str) -> int:
    """Newest version, 0 when there is none."""
    return runlog.head(spark, f"{root}/_log")


def write_snapshot(state: DataFrame, root: str, version: int | None = None) -> int:
    """Write the next version, or the one given. Readers see it once its number is claimed.

    A run that worked on version n writes `n + 1`: `Superseded` tells that another run was first, whose
    version stays as it is.
    """
    spark = state.sparkSession
    version = current_version(spark, root) + 1 if version is None else version
    folder = f"version={version}-{uuid.uuid4().hex}"
    state.write.parquet(f"{root}/{folder}")
    if version != current_version(spark, root) + 1 or not runlog.claim(spark, f"{root}/_log", version, {"folder": folder}):
        runlog.discard(spark, f"{root}/{folder}")
        raise Superseded(f"version {version} of {root} is taken")
    return version


def read_snapshot(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """Rows of the newest version, or of the one given; empty before the first run."""
    version = current_version(spark, root) if version is None else version
    if version == 0:
        return spark.createDataFrame([], schema(table))
    return spark.read.schema(schema(table)).parquet(f"{root}/{runlog.entry(spark, f'{root}/_log', version)['folder']}")
