"""Joins with hot keys: rows as of a plain join, and tasks of like size without adaptive execution."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from fieldsync.operators import skew


def side(spark, name, keys):
    return spark.createDataFrame([(k, f"u{k}" if k is not None else None, i) for i, k in enumerate(keys)], f"k int, s string, {name} long")


def some_keys(rng, hot, n, of):
    return [hot if rng.random() < 0.33 else rng.choice([None, *range(of)]) for _ in range(n)]


CASES = {
    "left": (lambda r: some_keys(r, 5, 600, 300), lambda r: [5, 5, *range(0, 300, 2)]),
    "right": (lambda r: [7, 7, None, *range(0, 300, 2)], lambda r: some_keys(r, 7, 600, 300)),
    "both": (lambda r: some_keys(r, 5, 300, 50), lambda r: some_keys(r, 5, 200, 50)),
    "two": (lambda r: some_keys(r, 5, 300, 50), lambda r: some_keys(r, 6, 300, 50)),
    "hot without partner": (lambda r: some_keys(r, 400, 300, 50), lambda r: some_keys(r, 401, 300, 50)),
    "repeated rows": (lambda r: [3] * 200, lambda r: [3] * 5 + [4] * 200),
    "nothing left": (lambda r: [], lambda r: [1, 1, 1]),
    "nothing right": (lambda r: [1, 1, 1, None], lambda r: []),
}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("case", CASES)
def test_rows_as_of_a_plain_join(spark, case, how):
    rng = random.Random(case)
    left, right = (side(spark, name, keys(rng)) for name, keys in zip(("a", "b"), CASES[case]))
    got = skew.skew_join(left, right, ["k", "s"], how, "a", "b", tasks=8)
    want = left.join(right, ["k", "s"], how).select(*got.columns)
    assert Counter(got.collect()) == Counter(want.collect())


def test_hot_keys_are_named(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    cells = skew.heavy_keys(rows, ["k"], 10).cells
    assert list(cells.values()) == [53]  # a third of the rows is 3.3 parts of 16 cells
    assert skew.heavy_keys(rows.where("k >= 0"), ["k"], 10).cells == {}
    assert skew.heavy_keys(rows.select(F.lit(None).cast("int").alias("k")), ["k"], 10).cells == {}


@pytest.mark.parametrize("hot", ["left", "right"])
def test_tasks_are_of_like_size(spark, hot):
    """A third of all rows under one key: no task has twice the median, with adaptive execution and broadcasts off."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        many = spark.range(60000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("a"))
        few = spark.range(-1, 5000).select(F.col("id").alias("k"), F.col("id").alias("b"))

        def sizes(df):
            return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]

        plain = sizes(many.join(few, "k"))
        assert max(plain) > 4 * median(plain)
        for how in ("inner", "left"):
            joined = skew.skew_join(many, few, ["k"], how, "a", "b") if hot == "left" else skew.skew_join(few, many, ["k"], how, "b", "a")
            got = sizes(joined.where("a is not null"))
            assert sum(got) == 60000
            if hot == "left" or how == "inner":
                assert len(got) == 16 and max(got) <= 2 * median(got)
            else:  # two joins after one another: cold keys, then the hot one in its cells
                assert max(got) <= 2 * (60000 / 16)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_other_joins_are_refused(spark):
    rows = side(spark, "a", [1])
    with pytest.raises(ValueError, match="full"):
        skew.skew_join(rows, rows, ["k"], "full", "a", "a")
    with pytest.raises(ValueError, match="right_by"):
        skew.skew_join(rows, rows, ["k"], "inner", "a")
