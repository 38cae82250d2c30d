"""One-pass comparison: partners within blocks, coverage and plans."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import reconcile_bars
from tidemark.operators.matching import with_partners

T0 = datetime(2025, 7, 2, 17, 59, 30, tzinfo=UTC)  # half a minute before a block of observations ends
KEY = "instrument_id string, timeframe string, timestamp_start timestamp"


@pytest.mark.parametrize("seed", range(4))
def test_partners_over_many_blocks_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = sorted({(rng.randrange(2), rng.randrange(-300, 300)): rng.randrange(4) for _ in range(160)}.items())
    rows = [(k, at, kind) for (k, at), kind in rows]
    tolerance = 5

    def brute(a, b):
        near = [(x, y) for x in rows for y in rows if x[2] == a and y[2] == b and x[0] == y[0] and abs(x[1] - y[1]) <= tolerance]
        return {(x, y) for x, y in near if sum(p[0] == x for p in near) == 1 and sum(p[1] == y for p in near) == 1}

    df = spark.createDataFrame(rows, "k long, at long, kind long").withColumn("_x", F.lit("kept"))
    roles = {"near": (F.col("kind") == 0, F.col("kind") == 1), "other": (F.col("kind") == 1, F.col("kind") == 2)}
    for block in (None, 1 << 20):
        found = with_partners(df, ["k"], F.col("at"), tolerance, roles, F.struct("at", "kind"), block).collect()
        assert sorted((r["k"], r["at"], r["kind"]) for r in found) == rows and {r["_x"] for r in found} == {"kept"}
        for name, (a, b) in (("near", (0, 1)), ("other", (1, 2))):
            want = brute(a, b)
            assert {(r["k"], r["at"], r["kind"]) for r in found if r[name]} == {x for pair in want for x in pair}
            assert {((r["k"], r["at"], r["kind"]), (r["k"], *r[f"{name}_partner"])) for r in found if r[f"{name}_partner"]} == want
    none = with_partners(df, ["k"], F.col("at"), 0, roles, F.col("at")).filter("near OR other OR near_partner IS NOT NULL")
    assert none.count() == 0


def starts(spark, *offsets, timeframe="5m"):
    return spark.createDataFrame([("i", timeframe, T0 + timedelta(seconds=s)) for s in offsets], KEY)


def test_missing_keys_are_aligned_across_a_block_boundary(spark):
    def bars(*offsets):
        return starts(spark, *offsets).selectExpr("*", "timestamp_start AS timestamp_end", "'regular' AS session", "'unadjusted' AS adjustment_state", "'USD' AS currency", *(f"1D AS {m}" for m in reconcile_bars.NUMERIC_METRICS), "'b' AS raw_batch_id")

    def missing(have, want):
        return sorted((r["timestamp_start"].replace(tzinfo=UTC) - T0).seconds for r in reconcile_bars.missing_expected(bars(*have), starts(spark, *want)).collect())

    assert missing([0], [60]) == [] and missing([0, 0], [60]) == []  # several rows align too
    assert missing([0], [61]) == [61]
    assert missing([0, 45], [20]) == [20]  # two candidates
    assert missing([60], [0, 60, 90]) == [0, 90]  # an expected key aligns with nothing
    pairs = reconcile_bars.shifted_pairs(bars(0, 300), bars(45, 300)).collect()
    assert [(r["left_start"].replace(tzinfo=UTC), r["right_start"].replace(tzinfo=UTC)) for r in pairs] == [(T0, T0 + timedelta(seconds=45))]


def test_plans_read_each_side_once(spark, sf):
    import re

    from tidemark.plans import reconcile_queries as q

    for name, scans, exchanges in (("bar_findings", 6, 2), ("bar_provider_metrics", 6, 3), ("missing_expected", 4, 2), ("segment_rollup", 4, 3), ("shifted_pairs", 4, 2)):
        plan = q.QUERIES[name][0](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("FileScan", plan)) <= scans and len(re.findall(" Exchange", plan)) <= exchanges and "Join" not in plan, name


def test_a_hot_instrument_is_many_tasks(spark):
    """One instrument with all rows: its blocks spread over the partitions."""
    rows = spark.range(40_000).select(F.lit(1).alias("k"), (F.col("id") * 300).alias("at"), (F.col("id") % 2).alias("kind"))
    found = with_partners(rows, ["k"], F.col("at"), 60, {"m": (F.col("kind") == 0, F.col("kind") == 1)})
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20_000
