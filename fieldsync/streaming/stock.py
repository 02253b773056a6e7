"""The stock job per micro-batch: each batch is a run of the state, named by its number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from fieldsync.config import StockConfig
from fieldsync.plans.stock import change_stock
from fieldsync.schemas import schema
from fieldsync.sources.staging import stage, staging
from fieldsync.sources.state import COMPACT_AT

RECEIPT, RETURN = "receipt", "return"

_TABLES = {RECEIPT: "receipt_events", RETURN: "return_events"}


def event_schema() -> StructType:
    """Columns of receipts and returns, and `event`, which tells them apart."""
    fields = {f.name: f for table in _TABLES.values() for f in schema(table).fields}
    return StructType(list(fields.values())).add("event", "string")


def stock_stream(
    events: DataFrame,
    root: str,
    name: str,
    dimensions: Callable[[SparkSession], dict[str, DataFrame]],
    checkpoint: str,
    cfg: StockConfig = StockConfig(),
    share: float | None = COMPACT_AT,
    **trigger,
) -> StreamingQuery:
    """Fold a stream of `event_schema()` rows into the stock state under `root`, batch after batch.

    A batch that changed the state before its query was killed is asked for again by the restarted one; its
    run id is known by then, so it has no second effect. `name` must stay that of the checkpoint. `dimensions` reads
    materials and contractors for each batch. Events are folded by `seq` within a batch, batches as they come; rows of another `event` are left out.
    `trigger` is that of `writeStream`.
    """

    def work(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with staging(spark):
            rows = stage(batch, "stream-events")  # read once: the job uses it several times
            told = [rows.where(F.col("event") == event).select(*schema(table).names) for event, table in _TABLES.items()]
            change_stock(spark, root, f"{name}-{number}", dimensions(spark), *told, cfg, share)

    writer = events.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(work)
    return (writer.trigger(**trigger) if trigger else writer).start()
