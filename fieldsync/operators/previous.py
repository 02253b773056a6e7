"""Mark rows whose predecessor under the same subject is flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldsync.operators.running import BLOCK_ROWS, Measure, plan_blocks


def previous_flagged(
    history: DataFrame, flagged: DataFrame, subject: str, id_column: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(id, previous_id, previous_flagged) for every row of a known subject.

    The predecessor is the row of the same subject with the next lower id. Id
    and flag travel in one number, so that a running maximum finds both.
    """
    marks = flagged.select(id_column).distinct().withColumn("_flag", F.lit(1))
    rows = (
        history.where(F.col(subject).isNotNull())
        .select(subject, id_column)
        .join(marks, id_column, "left")
        .withColumn("_code", F.col(id_column) * 2 + F.coalesce("_flag", F.lit(0)))
    )
    blocks = plan_blocks(history.where(F.col(subject).isNotNull()), [subject], id_column, block_rows)
    found = blocks.running(rows, {"_previous": Measure("max", F.col("_code"))}, before=True)
    return found.select(
        id_column,
        F.shiftright("_previous", 1).alias("previous_id"),
        F.coalesce(F.col("_previous") % 2 == 1, F.lit(False)).alias("previous_flagged"),
    )
