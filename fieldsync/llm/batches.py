"""Texts of Arrow batches in pieces of bounded size, and the path on which workers find this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Bytes of text that one step of a task works on; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def ship_code(spark: SparkSession) -> None:
    """Let Python workers find this package where it lies for the driver."""
    here = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if here not in known.split(":"):
        environment["PYTHONPATH"] = f"{here}:{known}" if known else here


def cuts(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """First row and number of rows of runs with at most `limit` bytes of text, or one row."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    first = 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield first, last - first
        first = last


def pieces(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into such runs."""
    for first, n in cuts(batch.column(column), limit):
        yield batch.slice(first, n)


def each_text(texts: pa.Array) -> Iterator[str]:
    """The texts as Python strings, empty for null; a run of them at a time."""
    for first, n in cuts(texts):
        yield from texts_of(texts.slice(first, n))


def give_back() -> None:
    """Return what a task has freed to the machine: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_of(array: pa.Array) -> list[str]:
    """The texts as Python strings, empty for null."""
    return [x if x is not None else "" for x in array.to_pylist()]
