"""Split a table of documents into valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.functions.documents import is_json


def split_documents(rows: DataFrame, column: str, applies: Column | None = None) -> dict[str, DataFrame]:
    """Valid rows (NULL documents included) and rejected rows.

    `applies` limits the test to the rows that are meant to hold a document.
    """
    bad = F.col(column).isNotNull() & ~is_json(F.col(column))
    if applies is not None:
        bad = bad & applies
    marked = rows.withColumn("_bad", bad)
    return {
        "valid": marked.where(~F.col("_bad")).drop("_bad"),
        "rejected": marked.where(F.col("_bad")).drop("_bad"),
    }


def document_counts(rows: DataFrame, column: str, by: list[str], **also: Column) -> DataFrame:
    """Rows, valid and rejected documents per group, and further aggregates by name, in one reading of the texts."""
    given = F.col(column).isNotNull()
    valid = is_json(F.col(column))
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(given & valid, 1)).alias("n_valid"),
        F.count(F.when(given & ~valid, 1)).alias("n_rejected"),
        *[value.alias(name) for name, value in also.items()],
    )
