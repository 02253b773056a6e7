"""Small runs of an outbox put together in segments, and the manifest that tells which are live.

A segment holds the rows of consecutive runs in ranges of message type and node. The manifest is an entry of a
log of its own (`_compacted`), claimed like a run's: it lists the live segments and the newest run in them. Who
reads takes the newest manifest and the runs after it; who has read an older one finds its files until `clear`.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fieldsync.sources import runlog
from fieldsync.sources.clustered import FILE_ROWS, write_clustered

_NONE: runlog.Entry = {"segments": [], "upto": 0, "cleared": 0}


def _log(path: str) -> str:
    return f"{path}/_compacted"


def manifest(spark: SparkSession, path: str) -> runlog.Entry:
    """The newest manifest: live segments, the newest run in them (`upto`), and up to which run single folders are gone (`cleared`)."""
    last = runlog.head(spark, _log(path))
    return runlog.entry(spark, _log(path), last) if last else {**_NONE, "entry": 0}


def read_segments(spark: SparkSession, path: str, declared: StructType, segments: list[dict]) -> DataFrame:
    folders = [f"{path}/{s['folder']}" for s in segments if s["rows"]]
    return spark.read.schema(declared).parquet(*folders) if folders else spark.createDataFrame([], declared)


def read_runs(spark: SparkSession, path: str, declared: StructType, runs: list[runlog.Entry]) -> DataFrame:
    """Rows of run folders, with their run id."""
    folders = [f"{path}/{run['folder']}" for run in runs if run["written"]]
    if not folders:
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).option("basePath", f"{path}/_runs").parquet(*folders).select(*declared.names)


def _absorbed(segments: list[dict], n_rows: int) -> int:
    """How many of the newest segments go into the next one: those no larger than what is there by then.

    Segments so halve in size from the oldest to the newest, and a row is rewritten a logarithmic number of times.
    """
    count = 0
    while count < len(segments) and segments[-1 - count]["rows"] <= n_rows:
        n_rows += segments[-1 - count]["rows"]
        count += 1
    return count


def compact_runs(spark: SparkSession, path: str, declared: StructType, finish, keys: Sequence[str], lookups: Sequence[str], file_rows: int = FILE_ROWS) -> bool:
    """Put the runs since the newest manifest into a segment; False if there are none or another compaction was first.

    `finish` is applied to the rows before they are written. Runs that come meanwhile are left for the next time.
    """
    live = manifest(spark, path)
    runs = runlog.entries(spark, f"{path}/_log", after=live["upto"])
    if not runs:
        return False
    n_rows = sum(run["written"] for run in runs)
    kept = len(live["segments"]) - _absorbed(live["segments"], n_rows)
    old = live["segments"][kept:]
    n_rows += sum(s["rows"] for s in old)
    folder = f"_segments/{uuid.uuid4().hex}"
    if n_rows:
        rows = read_segments(spark, path, declared, old).unionByName(finish(read_runs(spark, path, declared, runs)))
        write_clustered(rows, f"{path}/{folder}", keys, n_rows, lookups, file_rows)
    segments = [*live["segments"][:kept], {"folder": folder, "rows": n_rows}]
    content = {"segments": segments, "upto": runs[-1]["entry"], "cleared": live["cleared"]}
    if runlog.claim(spark, _log(path), live["entry"] + 1, content):
        return True
    runlog.discard(spark, f"{path}/{folder}")
    return False


def clear(spark: SparkSession, path: str) -> bool:
    """Take away run folders and segments that the newest manifest has put together, once nobody reads by an older one.

    Run ids and refused rows stay. False if another one has written a manifest meanwhile.
    """
    live = manifest(spark, path)
    past = runlog.entries(spark, _log(path), upto=live["entry"])
    content = {"segments": live["segments"], "upto": live["upto"], "cleared": live["upto"]}
    if live["cleared"] == live["upto"] or not runlog.claim(spark, _log(path), live["entry"] + 1, content):
        return False
    for run in runlog.entries(spark, f"{path}/_log", after=live["cleared"], upto=live["upto"]):
        runlog.discard(spark, f"{path}/{run['folder']}")
    kept = {s["folder"] for s in live["segments"]}
    for folder in {s["folder"] for entry in past for s in entry["segments"]} - kept:
        runlog.discard(spark, f"{path}/{folder}")
    return True
