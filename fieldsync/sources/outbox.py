"""Outbox and landing sinks: defaults, ids, length rule, append per run, acknowledgements."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fieldsync.functions.documents import member
from fieldsync.operators.keyed import absent, highest, latest_per_key
from fieldsync.schemas import schema
from fieldsync.sources import runlog
from fieldsync.sources.clustered import FILE_ROWS
from fieldsync.sources.compaction import compact_runs, manifest, read_runs, read_segments
from fieldsync.sources.staging import LONG_ROWS, stage

# Fixed value: longest request or response the outbox tables take.
MAX_DOCUMENT = 500_000

# Columns that are false unless a job sets them.
_FALSE_BY_DEFAULT = {
    "status",
    "status_created",
    "status_updated",
    "inserted",
    "updated",
    "devicecreation_mdm",
    "devicecreation_hes",
}
# Columns that take the time of the append unless a job sets them.
_NOW_BY_DEFAULT = {"created_datetime", "createddatetime", "created"}


def with_defaults(rows: DataFrame, table: str, id_column: str | None = None) -> DataFrame:
    """All columns of the table in declared order, with the sink's defaults filled in."""
    columns = []
    for field in schema(table).fields:
        if field.name == id_column:
            continue
        if field.name in rows.columns:
            value = F.col(field.name)
        elif field.name in _FALSE_BY_DEFAULT:
            value = F.lit(False)
        elif field.name in _NOW_BY_DEFAULT:
            value = F.current_timestamp()
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def with_serial(outbox: DataFrame) -> DataFrame:
    """Outbox with the serial of the request as a column, read from the text in rows that don't keep it."""
    told = member(F.col("request"), "serialNumber")
    kept = F.coalesce(F.col("serial_number"), told) if "serial_number" in outbox.columns else told
    return outbox.withColumn("serial_number", kept)


class Run(NamedTuple):
    """What a run has written, and the rows it refused, with `reject_reason`."""

    written: DataFrame
    rejected: DataFrame


# Rows are numbered in parts of 4096: what is known of a part, its first number and the refused rows in it, is staged, so that
# the join knows how small it is and doesn't shuffle the rows.
_PART_BITS = 12

#: Why the outbox refuses a row.
TOO_LONG = "request_too_long"


def reject_reason(columns: list[str]) -> Column:
    """Why the declared length of the outbox refuses a row; null if it takes it."""
    refused = [F.col(c).isNotNull() & (F.char_length(c) > MAX_DOCUMENT) for c in ("request",) if c in columns]
    return F.when(refused[0], F.lit(TOO_LONG)) if refused else F.lit(None).cast("string")


def _written(spark: SparkSession, folder: str, declared: StructType) -> DataFrame | None:
    """Rows of a folder; None if it isn't there."""
    try:
        return spark.read.schema(declared).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def log_head(spark: SparkSession, path: str) -> int:
    """Number of the newest run of the outbox: taken before the log is read, it tells `append_run` what the delta has seen."""
    return runlog.head(spark, f"{path}/_log")


def _runs(spark: SparkSession, path: str, declared: StructType, runs: list[runlog.Entry]) -> DataFrame:
    """Rows of these runs, with their run id: from their own folders, or from segments where these are gone."""
    live = manifest(spark, path)
    alone = [run for run in runs if run.get("entry", live["cleared"] + 1) > live["cleared"]]
    rows = read_runs(spark, path, declared, alone)
    if len(alone) == len(runs):
        return rows
    gone = [run["run_id"] for run in runs if run.get("entry", live["cleared"] + 1) <= live["cleared"]]
    named = declared if "run_id" in declared.names else StructType([*declared.fields]).add("run_id", "string")
    together = read_segments(spark, path, named, live["segments"])
    return rows.unionByName(together.where(F.col("run_id").isin(gone)).select(*declared.names))


def _told(spark: SparkSession, path: str, run: runlog.Entry, declared: StructType, refusable: StructType) -> Run:
    refused = spark.read.schema(refusable).parquet(f"{path}/{run['refused']}") if run["refused"] else spark.createDataFrame([], refusable)
    return Run(_runs(spark, path, declared, [run]), refused)


def append_run(rows: DataFrame, table: str, path: str, run_id: str, id_column: str, known: DataFrame, unique: Sequence[Sequence[str]] = (), seen: int = 0) -> Run:
    """Append a delta under its run id, give the rows ids above the known ones, return what was written and what was refused.

    Runs may write the same outbox at once. Ids come from ranges that are claimed
    for one run each, above the highest known id; they are unique, rise from claim to claim,
    and some may stay unused, as with a sequence. A run's rows lie in a folder of their own until it
    claims the next entry of the outbox's log, which makes them visible in one step: a
    run that dies before leaves nothing to be seen.
    `unique` names key columns that no two runs may both write, such as `[["distnid"]]`: when other runs have got
    in since entry `seen` (`log_head` before the log was read; 0 checks all runs), rows whose keys those runs wrote are left out,
    as if conflicting rows were inserted with nothing done. Unknown keys don't conflict; keys within the run are the job's affair.

    A run that has written or refused rows stays as it is, so that a rerun, whose
    delta is blocked by its own messages, gives back what the first one sent.
    Rows whose request is too long get no id and are kept with the run; a rerun gives them back too.
    Rows lie in the order of their message type, and a job writes one type, so
    that a reader of one type skips the other files by their statistics.
    Requests may be megabytes long: whatever is written here has small row groups (`LONG_ROWS`).
    """
    spark = rows.sparkSession
    declared = schema(table)
    refusable = StructType([f for f in declared.fields if f.name != id_column]).add("reject_reason", "string")
    log = f"{path}/_log"
    checked = runlog.head(spark, log)
    before = runlog.entries(spark, log, upto=checked)
    if done := [run for run in before if run["run_id"] == run_id]:
        return _told(spark, path, done[0], declared, refusable)
    attempt = f"run_id={run_id}/attempt={uuid.uuid4().hex}"
    filled = with_defaults(rows, table, id_column)
    filled = filled.withColumn("reject_reason", reject_reason(filled.columns))
    # The delta may read the outbox: it is settled before the log is claimed.
    filled = filled.withColumn("_at", F.monotonically_increasing_id())
    everything = stage(filled, "run-rows", **LONG_ROWS).withColumn("_part", F.shiftright("_at", _PART_BITS))
    is_refused = F.col("reject_reason").isNotNull()
    refused, kept = everything.where(is_refused).drop("_at", "_part"), everything.where(~is_refused).drop("reject_reason")
    n_refused, n_kept = everything.agg(F.count("reject_reason"), F.count(F.when(~is_refused, 1))).first()
    content = {"run_id": run_id, "folder": f"_runs/{attempt}", "refused": f"_rejected/{attempt}" if n_refused else None}
    if n_refused:
        refused.write.options(**LONG_ROWS).parquet(f"{path}/{content['refused']}")
    numbered = kept
    if n_kept:
        parts = everything.groupBy("_part").agg(F.count(F.when(~is_refused, 1)).alias("_n"), F.collect_list(F.when(is_refused, F.col("_at"))).alias("_left_out"))
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
        parts = parts.select("_part", "_left_out", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
        first = F.lit(runlog.claim_range(spark, f"{path}/_ids", n_kept, highest(known, id_column))).cast("long")
        gaps = F.size(F.filter("_left_out", lambda at: at < F.col("_at")))
        nth = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1)) - gaps
        wanted = [c for c in kept.columns if c not in ("_at", "_part")]
        numbered = kept.join(stage(parts, "run-parts"), "_part").select((first + nth).alias(id_column), *wanted)
    newer, n_written = before[seen:], None
    while True:
        if n_written is None or (n_written and unique and newer):
            others = _runs(spark, path, declared, newer) if unique and newer else None
            for keys in unique if others is not None else ():
                numbered = absent(numbered, others, list(keys))
            if n_written is not None:
                runlog.discard(spark, f"{path}/{content['folder']}")
            n_written = n_kept
            if n_kept:
                in_order = numbered.sortWithinPartitions("type_id") if "type_id" in numbered.columns else numbered
                in_order.write.options(**LONG_ROWS).parquet(f"{path}/{content['folder']}")
                n_written = spark.read.schema(declared).parquet(f"{path}/{content['folder']}").count()
        if not n_written and not n_refused:
            return Run(spark.createDataFrame([], declared), spark.createDataFrame([], refusable))
        if runlog.claim(spark, log, checked + 1, {**content, "written": n_written}):
            return _told(spark, path, {**content, "written": n_written}, declared, refusable)
        newer = runlog.entries(spark, log, after=checked)
        checked = newer[-1]["entry"]
        if done := [run for run in newer if run["run_id"] == run_id]:
            for folder in (content["folder"], content["refused"]):
                if folder:
                    runlog.discard(spark, f"{path}/{folder}")
            return _told(spark, path, done[0], declared, refusable)


def read_outbox(spark, path: str, table: str) -> DataFrame:
    """All runs, with their run id: those of the log, and folders `run_id=...` that were put there by hand."""
    declared = schema(table).add("run_id", "string")
    live = manifest(spark, path)
    logged = read_runs(spark, path, declared, runlog.entries(spark, f"{path}/_log", after=live["upto"]))
    if live["segments"]:
        logged = read_segments(spark, path, declared, live["segments"]).unionByName(logged)
    given = _written(spark, path, declared)
    return logged if given is None else given.unionByName(logged)


def compact(spark: SparkSession, path: str, table: str, id_column: str, node: str | None = "distnid", file_rows: int = FILE_ROWS) -> bool:
    """Put the runs since the last time into files by message type, node and id; serials are read from the requests once.

    Readers see the same messages before and after, and runs may be appended meanwhile. False if there was nothing to do.
    """
    declared = schema(table).add("run_id", "string")
    keys = [c for c in ("type_id", node, id_column) if c in declared.names]
    lookups = [c for c in (node, "serial_number") if c in declared.names]
    finish = with_serial if {"request", "serial_number"} <= set(declared.names) else lambda rows: rows
    return compact_runs(spark, path, declared, finish, keys, lookups, file_rows)


def acknowledged(outbox: DataFrame, acknowledgements: DataFrame, id_column: str) -> DataFrame:
    """Outbox rows with what their sender said of them last.

    Runs are never changed: the sender appends to a log of its own
    (`acknowledgement`: message id, status, response, push time, and `seq` of
    the entry), and the newest entry of a message holds.
    """
    told = ("status", "response", "push_datetime")
    newest = latest_per_key(acknowledgements, ["message_id"], "seq", list(told))
    newest = newest.select(F.col("message_id").alias(id_column), *[F.col(c).alias(f"_{c}") for c in told])
    joined = outbox.join(newest, id_column, "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in told else F.col(c) for c in outbox.columns])


def returned(written: DataFrame) -> DataFrame:
    """What the install jobs hand back for sending: (respid, url, json1, codepart)."""
    return written.select(
        F.col("id").alias("respid"),
        F.lit("").alias("url"),
        F.col("request").alias("json1"),
        F.col("type_id").alias("codepart"),
    )


def land_raw(rows: DataFrame, details: str, activity: str) -> DataFrame:
    """Raw payloads of a master pull, marked with the activity they came from."""
    return with_defaults(
        rows.withColumn("details", F.col(details)).withColumn("activity_type", F.lit(activity)),
        "master_landing",
        "mcd_id",
    )


def land_api(rows: DataFrame, details: str, kind: str, activity: str) -> DataFrame:
    """Raw payloads of a stock call before they are worked on."""
    return with_defaults(
        rows.withColumn("details", F.col(details))
        .withColumn("type", F.lit(kind))
        .withColumn("wh_activity", F.lit(activity)),
        "api_landing",
        "crvid",
    )
