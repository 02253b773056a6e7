"""State tables that are changed by key: a base, then changes, folded when read.

A run writes what it changes and no more: the keys whose rows go, and the rows
that come. Several tables change in one step, the claim of the next entry
of the state's log. A row is live if no later entry removes its key; a
removal does not touch rows that come with it, and unknown keys are never
removed. A new base is written when the changes have grown to a share of it,
so that a reader folds little. Folders that an entry names are never written
again or deleted, so readers of an older entry stay right.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldsync.schemas import schema
from fieldsync.sources import runlog

Keys = Mapping[str, Sequence[str]]

#: A new base is due when the changes since the last one have this share of its rows.
COMPACT_AT = 0.25


class Change(NamedTuple):
    """What a run does to a table: keys whose rows go, rows that come."""

    removed: DataFrame
    added: DataFrame


class Superseded(Exception):
    """Another run has changed the state since it was read."""


def _log(root: str) -> str:
    return f"{root}/_log"


def _write(df: DataFrame, root: str, folder: str) -> int:
    """Rows written; empty tables leave no folder behind."""
    path = f"{root}/{folder}"
    df.write.parquet(path)
    n = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if not n:
        runlog.discard(df.sparkSession, path)
    return n


def _commit(spark: SparkSession, root: str, after: int, kind: str, run_id: str | None, changes: Mapping[str, Change]) -> int:
    tables, attempt = {}, uuid.uuid4().hex
    for table, change in changes.items():
        tables[table] = {}
        for part, rows in (("removed", change.removed), ("added", change.added)):
            folder = f"{table}/{part}-{attempt}"
            n = _write(rows, root, folder) if rows is not None else 0
            tables[table][part] = {"folder": folder if n else None, "rows": n}
    if not runlog.claim(spark, _log(root), after + 1, {"kind": kind, "run_id": run_id, "tables": tables}):
        for parts in tables.values():
            for part in parts.values():
                if part["folder"]:
                    runlog.discard(spark, f"{root}/{part['folder']}")
        raise Superseded(f"entry {after + 1} of {root} is taken")
    return after + 1


def _since_base(spark: SparkSession, root: str, at: int) -> list[runlog.Entry]:
    """The newest base up to entry `at`, and the changes after it."""
    out: list[runlog.Entry] = []
    for number in range(at, 0, -1):
        out.insert(0, runlog.entry(spark, _log(root), number))
        if out[0]["kind"] == "base":
            break
    return out


def _parts(spark: SparkSession, root: str, entries: list[runlog.Entry], table: str, part: str, declared: StructType) -> DataFrame:
    """Rows of one part of these entries, with the number of the entry."""
    out = spark.createDataFrame([], StructType([*declared.fields]).add("_entry", "long"))
    for e in entries:
        if folder := e["tables"].get(table, {}).get(part, {}).get("folder"):
            rows = spark.read.schema(declared).parquet(f"{root}/{folder}")
            out = out.unionByName(rows.withColumn("_entry", F.lit(e["entry"]).cast("long")))
    return out


def read_state(spark: SparkSession, root: str, keys: Keys, at: int | None = None) -> dict[str, DataFrame]:
    """Live rows of every table, as of the newest entry or the one given; empty before the first."""
    entries = _since_base(spark, root, runlog.head(spark, _log(root)) if at is None else at)
    out = {}
    for table, key in keys.items():
        declared = schema(table)
        rows = _parts(spark, root, entries, table, "added", declared)
        gone = _parts(spark, root, entries, table, "removed", StructType([declared[k] for k in key]))
        # One row per key: the join can't multiply rows. The changes are the small side.
        gone = gone.groupBy(*key).agg(F.max("_entry").alias("_gone"))
        live = rows.join(gone, list(key), "left").where(F.col("_gone").isNull() | (F.col("_gone") <= F.col("_entry")))
        out[table] = live.select(*declared.names)
    return out


def start_state(spark: SparkSession, root: str, tables: Mapping[str, DataFrame], keys: Keys) -> int:
    """Write the first base. `Superseded` if there is one."""
    return _commit(spark, root, 0, "base", None, {t: Change(None, tables[t].select(*schema(t).names)) for t in keys})


def compact(spark: SparkSession, root: str, keys: Keys, share: float = COMPACT_AT) -> bool:
    """Fold the changes into a new base once they have the given share of its rows. Whoever is late leaves it to the next run."""
    at = runlog.head(spark, _log(root))
    entries = _since_base(spark, root, at)
    changed = sum(p["rows"] for e in entries if e["kind"] == "change" for parts in e["tables"].values() for p in parts.values())
    base = sum(p["rows"] for e in entries if e["kind"] == "base" for parts in e["tables"].values() for p in parts.values())
    if not changed or changed < share * base:
        return False
    state = read_state(spark, root, keys, at)
    try:
        _commit(spark, root, at, "base", None, {t: Change(None, state[t]) for t in keys})
    except Superseded:
        return False
    return True


def change_state(
    spark: SparkSession,
    root: str,
    keys: Keys,
    run_id: str,
    job: Callable[[dict[str, DataFrame]], Mapping[str, Change]],
    share: float | None = COMPACT_AT,
) -> int:
    """Change the state by a job that is given its tables, and return the entry of the run.

    A run that has changed the state already is not run again. If another run gets in between, the job
    is run again on what that one left, so that runs act as if one came after the other.
    """
    checked, done = 0, None
    while done is None:
        at = runlog.head(spark, _log(root))
        mine = [e["entry"] for e in runlog.entries(spark, _log(root), checked, at) if e["run_id"] == run_id]
        if mine:
            return mine[0]
        checked = at
        try:
            done = _commit(spark, root, at, "change", run_id, job(read_state(spark, root, keys, at)))
        except Superseded:
            continue
    if share is not None:
        compact(spark, root, keys, share)
    return done
