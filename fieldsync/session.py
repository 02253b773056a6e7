"""Session settings the jobs are tuned for. On a cluster they belong in spark-defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs a further shuffle after it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Few wanted keys reach the Bloom filters of a scan one by one, not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Without these a hot key on one side of a join stays in one task.
NEEDED = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")


def lacking(spark: SparkSession) -> dict[str, str]:
    """Settings that hot keys depend on and the session has switched off."""
    return {key: SETTINGS[key] for key in NEEDED if spark.conf.get(key, "true") != SETTINGS[key]}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fieldsync")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
