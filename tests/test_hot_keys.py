"""Operators whose key may hold a third of all rows: equal results, and many tasks for that key."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import reference_data, validation
from tidemark.plans import adapters

T0 = datetime(2025, 7, 2, tzinfo=UTC)


def spread(df, key, value):
    """Partitions that hold rows of a key in the last stage, and the most rows of it in one."""
    rows = df.filter(F.col(key).eqNullSafe(F.lit(value))).groupBy(F.spark_partition_id().alias("p")).count().collect()
    return len(rows), max(r["count"] for r in rows)


@pytest.mark.parametrize("block", [60, 600])
def test_credit_windows_over_blocks_agree_with_brute_force(spark, block):
    rng = random.Random(block)
    rows = [(i, rng.choice(["a", "a", "b", None]), T0 + timedelta(seconds=rng.choice([0, 60, 119, 120, 600]) + rng.randrange(2000), microseconds=rng.choice([0, 1, 999_999])), rng.randrange(4)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, who string, ts timestamp, cost int")
    found = {r["id"]: r for r in clock.credit_windows(df, "who", "ts", "cost", 60, 8, block).collect()}
    for i, who, ts, _ in rows:
        own = [r for r in rows if r[1] == who and r[2] <= ts]
        total, recent = sum(r[3] for r in own), sum(r[3] for r in own if ts - r[2] < timedelta(seconds=60))
        assert (found[i]["used_60s"], found[i]["used_total"], found[i]["over_rate"], found[i]["over_total"]) == (recent, total, recent > 8, total > 60)
    assert set(df.columns) < set(clock.credit_windows(df, "who", "ts", "cost", 60).columns)


def test_a_hot_provider_is_many_tasks(spark):
    log = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 50)).alias("who"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.lit(1).alias("cost"))
    tasks, most = spread(clock.credit_windows(log, "who", "ts", "cost", 10**6), "who", "hot")
    assert tasks == 4 and most < 4000


def test_numbering_across_partitions(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["w", "w", "x", None]), k) for k in rng.sample(range(100_000), 5000)]
    df = spark.createDataFrame(rows, "w string, k long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart, as large ones would
    placed = reference_data.numbered(df, "w", "k", "place")
    want = {(w, k): n for w in ("w", "x", None) for n, k in enumerate(sorted(k for v, k in rows if v == w))}
    assert {(r["w"], r["k"]): r["place"] for r in placed.collect()} == want
    tasks, most = spread(placed, "w", "w")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks >= 2 and most < 2000
    plan = reference_data.request_plan(df, "w", "k", 7, False).collect()
    for w in ("w", "x", None):
        own = sorted((r["batch"], r["members"], r["refs"], r["credits"]) for r in plan if r["w"] == w)
        keys = sorted(k for v, k in rows if v == w)
        assert own == [(n + 1, keys[7 * n : 7 * n + 7], len(keys[7 * n : 7 * n + 7]), 1) for n in range(-(-len(keys) // 7))]


def test_a_repeated_observation_key_is_many_tasks(spark, sf):
    """One key holds a third of all rows; with a broadcast and with a join by key all are flagged, and no task has them all."""
    bars = adapters.bars(spark, sf).withColumn("n", F.monotonically_increasing_id())
    hot = bars.first()
    third = F.pmod(F.xxhash64("n"), F.lit(3)) == 0
    many = bars.withColumns({k: F.when(third, F.lit(hot[k])).otherwise(F.col(k)) for k in validation.DUPLICATE_KEY})
    n = many.filter(third).count()
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}
    for conf in ({}, settings):
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            flagged = validation.validate_bars(many)
            rows = flagged.filter(third).groupBy(F.spark_partition_id().alias("p"), F.array_contains("quality_flags", "duplicate_bar").alias("d")).count().collect()
        finally:
            for k in conf:
                spark.conf.unset(k)
        assert {r["d"] for r in rows} == {True} and sum(r["count"] for r in rows) == n
        assert not conf or max(r["count"] for r in rows) < n


def test_repeats_by_null_keys_and_batches(spark):
    rows = [("i", None, "a"), ("i", None, "b"), ("j", None, "a")]
    df = spark.createDataFrame(rows, "instrument_id string, session string, raw_batch_id string")
    assert sorted((r["instrument_id"], r["d"]) for r in validation.with_repeats(df, ("instrument_id", "session"), "d").collect()) == [("i", True), ("i", True), ("j", False)]
    assert not validation.with_repeats(df, ("instrument_id", "session", "raw_batch_id"), "d").filter("d").count()
