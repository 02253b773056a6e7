"""Numbered entries of a folder: whoever creates the next file first has the number.

A claim is one step of the file system, so that runs that know nothing of each
other agree on an order. It needs a file system that refuses to rename a file
onto another one, as HDFS does; on a local one a hard link does the same.
Entries are small and hold numbers and folder names, never rows.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import SparkSession

Entry = dict[str, Any]


def _at(spark: SparkSession, path: str):
    """File system and path of the JVM, for the driver's own small files."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:020d}.json"


def discard(spark: SparkSession, folder: str) -> None:
    """Take away a folder that no entry names."""
    fs, target = _at(spark, folder)
    fs.delete(target, True)


def head(spark: SparkSession, folder: str) -> int:
    """Number of the newest entry, 0 when there is none."""
    fs, target = _at(spark, folder)
    if not fs.exists(target):
        return 0
    names = (s.getPath().getName() for s in fs.listStatus(target))
    return max((int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)


def entry(spark: SparkSession, folder: str, number: int) -> Entry:
    fs, target = _at(spark, _file(folder, number))
    stream = fs.open(target)
    try:
        return {**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")), "entry": number}
    finally:
        stream.close()


def entries(spark: SparkSession, folder: str, after: int = 0, upto: int | None = None) -> list[Entry]:
    """Entries above `after`, in order, up to the newest one or to the one given."""
    last = head(spark, folder) if upto is None else upto
    return [entry(spark, folder, n) for n in range(after + 1, last + 1)]


@contextmanager
def _draft(spark: SparkSession, folder: str, text: str) -> Iterator[str]:
    path = f"{folder}/.draft-{uuid.uuid4().hex}"
    fs, target = _at(spark, path)
    stream = fs.create(target, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        yield path
    finally:
        if fs.exists(target):
            fs.delete(target, False)


def claim(spark: SparkSession, folder: str, number: int, content: Entry) -> bool:
    """Create the entry of this number with its whole content; False if it is there already."""
    with _draft(spark, folder, json.dumps(content)) as draft:
        fs, target = _at(spark, _file(folder, number))
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(_at(spark, draft)[1], target))
        try:
            os.link(_at(spark, draft)[1].toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        return True


def claim_range(spark: SparkSession, folder: str, count: int, above: int) -> int:
    """First of `count` numbers that nobody else gets, over `above` and all that were handed out. Unused ones are lost, as with a sequence."""
    while True:
        last = head(spark, folder)
        handed = entry(spark, folder, last)["last"] if last else 0
        first = max(above, handed) + 1
        if claim(spark, folder, last + 1, {"first": first, "last": first + count - 1}):
            return first
