"""Reading operational tables with their declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldsync.schemas import schema


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(schema(table)).parquet(f"{root}/{table}")


def read_tables(spark: SparkSession, root: str, tables: list[str]) -> dict[str, DataFrame]:
    return {table: read_table(spark, root, table) for table in tables}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], schema(table))
