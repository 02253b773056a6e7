import random

import pytest
from pyspark.sql import functions as F

from fieldsync.operators.keyed import first_per_key, latest_per_key
from fieldsync.operators.previous import previous_flagged
from fieldsync.operators.running import Measure, plan_blocks


def plain(rows, before):
    out = {}
    for key, seq, x in rows:
        seen = [v for k, s, v in rows if k == key and (s < seq if before else s <= seq) and v is not None]
        out[seq] = (sum(seen) if seen else None, min(seen, default=None), max(seen, default=None))
    return out


@pytest.mark.parametrize("before", [True, False])
@pytest.mark.parametrize("block_rows", [10**6, 7])
def test_running_equals_plain_definition(spark, before, block_rows):
    rng = random.Random(5)
    # One key holds most rows, and the order column has gaps.
    rows = [(rng.choice([1, 1, 1, 1, 2, 3]), seq * rng.randint(7, 9) * 1000 + seq, rng.choice([None, 1, 2, -5])) for seq in range(1, 90)]
    df = spark.createDataFrame(rows, "key int, seq long, x int")
    blocks = plan_blocks(df, ["key"], "seq", block_rows)
    assert (blocks.huge is not None) == (block_rows == 7)
    out = blocks.running(df, {n: Measure(n, F.col("x")) for n in ("sum", "min", "max")}, before=before)
    assert {r["seq"]: (r["sum"], r["min"], r["max"]) for r in out.collect()} == plain(rows, before)


def largest_block(blocks, rows):
    usual, huge = blocks.cut(rows)
    assert usual.groupBy("key").count().where(F.col("count") > 1000).isEmpty()
    return huge.groupBy("key", "_block").count().agg(F.max("count")).first()[0]


def test_bursts_and_opening_rows(spark):
    """Order values that are far from even: an opening row at 0, then microseconds, half of them in one burst."""
    at = F.lit(1_700_000_000_000_000) + F.when(F.col("id") < 20_000, F.col("id")).otherwise(F.col("id") * 1_000_000)
    rows = spark.range(40_000).select(F.lit(1).alias("key"), F.when(F.col("id") == 0, 0).otherwise(at).alias("seq"))
    blocks = plan_blocks(rows, ["key"], "seq", 1_000)
    assert largest_block(blocks, rows) <= 1_000
    out = blocks.running(rows, {"n": Measure("sum", F.lit(1))})
    assert [r["n"] for r in out.orderBy("seq").collect()] == [*range(1, 40_001)]


def test_many_huge_keys(spark):
    rows = spark.range(1_500 * 40).select((F.col("id") % 1_500).alias("key"), F.col("id").alias("seq")).unionByName(spark.range(300).select(F.lit(-1).alias("key"), F.col("id").alias("seq")))
    blocks = plan_blocks(rows, ["key"], "seq", 30)
    assert blocks.huge.count() == 1_501
    assert largest_block(blocks, rows) <= 40
    out = blocks.running(rows, {"n": Measure("sum", F.lit(1))})
    assert out.groupBy("key").agg(F.max("n").alias("n"), F.count_distinct("n").alias("d")).where("n <> d OR n NOT IN (40, 300)").isEmpty()


def test_small_blocks_of_many_rows_share_partitions(spark):
    """The number of range partitions follows the rows, not the blocks, and rows of equal order stay in one block."""
    rows = spark.range(60_000).select((F.col("id") % 3).alias("key"), F.floor(F.col("id") / 12).alias("seq"))
    blocks = plan_blocks(rows, ["key"], "seq", 100)
    assert blocks.partitions <= spark.sparkContext.defaultParallelism
    _, huge = blocks.cut(rows)
    per_block = huge.groupBy("key", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first"), F.max("seq").alias("last")).collect()
    assert len(per_block) >= 1_200 and max(r["n"] for r in per_block) <= 100
    in_order = sorted((r["key"], r["_block"], r["first"], r["last"]) for r in per_block)
    assert all(a[0] != b[0] or a[3] < b[2] for a, b in zip(in_order, in_order[1:]))
    out = blocks.running(rows, {"n": Measure("sum", F.lit(1))})
    assert out.where(F.col("n") != 4 * (F.col("seq") + 1)).isEmpty()


@pytest.mark.parametrize("block_rows", [10**6, 4])
def test_previous_flagged(spark, block_rows):
    rng = random.Random(3)
    rows = [(rng.choice([7, 7, 7, 8, None]), i) for i in range(1, 60)]
    flagged = {i for _, i in rows if i % 4 == 0}
    history = spark.createDataFrame(rows, "node int, id long")
    marks = previous_flagged(history, spark.createDataFrame([(i,) for i in flagged], "id long"), "node", "id", block_rows)
    got = {r["id"]: (r["previous_id"], r["previous_flagged"]) for r in marks.collect()}
    for node, i in rows:
        if node is None:
            assert i not in got
            continue
        earlier = max((j for n, j in rows if n == node and j < i), default=None)
        assert got[i] == (earlier, earlier in flagged)


def test_first_and_latest_per_key(spark):
    rows = spark.createDataFrame(
        [(1, "a", "x"), (2, "a", "y"), (3, None, "p"), (4, None, "q"), (5, "b", "z")], "seq int, key string, v string"
    )
    assert {r["seq"] for r in first_per_key(rows, ["key"], "seq").collect()} == {1, 3, 4, 5}
    latest = latest_per_key(rows.where("key is not null"), ["key"], "seq", ["v"])
    assert {tuple(r) for r in latest.collect()} == {("a", "y"), ("b", "z")}
