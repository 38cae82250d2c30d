"""Steps whose work or memory once grew faster than their input."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import study
from tidemark.plans import action_queries, evidence_queries, normalize_queries, pipeline_queries, reconcile_queries
from tidemark.sources import normalize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_days_of_windows_are_never_the_broadcast_side(spark, sf):
    for query in (evidence_queries.overlapping_keys, action_queries.expected_keys):
        assert "BuildLeft" not in plan(query(spark, sf))
    windows = spark.sql("SELECT 's' AS segment, 1L AS instrument_id, '5m' AS timeframe, TIMESTAMP'2024-01-02 14:31:00' AS start, TIMESTAMP'2024-01-04 20:00:00' AS end")
    days = spark.sql("SELECT explode(sequence(DATE'2023-01-01', DATE'2024-12-31')) AS session_date")
    off = clock.misaligned_windows(windows, clock.sessions(days))
    assert "BuildLeft" not in plan(off)
    assert [str(r.session_date) for r in off.collect()] == ["2024-01-02"]


def test_targets_are_counted_before_they_meet_windows(spark):
    windows = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "v"), ("d", "none")], "label string, universe string")
    targets = spark.createDataFrame([("u", "X", "1"), ("u", "X", "2"), ("u", "Y", "3"), ("u", None, "4"), ("v", "X", "1")], "universe string, symbol string, instrument_id string")
    want = study.window_targets(windows, targets).groupBy("label").agg(F.count(F.lit(1)).alias("targets"), F.count_distinct("symbol").alias("symbols"))
    got = study.target_counts(windows, targets).select("label", "targets", "symbols")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [("a", 4, 2), ("b", 4, 2), ("c", 1, 1)]


def test_rows_without_a_symbol_are_dealt_over_tasks(spark):
    refs = spark.createDataFrame([("r1", "A", "1"), ("r1", "B", "2"), ("r2", "A", "3")], "request_id string, provider_identifier string, instrument_id string")
    rows = spark.range(400).select(F.lit("r1").alias("request_id"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("raw_batch_id"), F.when(F.col("id") % 100 == 7, "A").when(F.col("id") % 100 == 8, "c1").alias("symbol"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = normalize._looked_up(rows, refs, "symbol", "instrument_id").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(found) == 400 and {(r.symbol, r.instrument_id) for r in found} == {("A", "1"), ("c1", None), (None, None)}
    assert len({r.part for r in found if r.symbol is None}) > 1


def test_records_are_read_by_one_cast_and_filters_do_not_repeat_the_parse(spark, sf):
    text = plan(normalize_queries.QUERIES["normalize_c_bars"][0](spark, sf))
    assert text.count("parseJson") == 1 and text.count("try_variant_get") == 2


@pytest.mark.parametrize("name", ["bar_findings", "finding_counts_by_class", "finding_counts_by_metric", "sanitized_findings", "numeric_differences", "first_findings", "segment_rollup"])
def test_findings_are_compiled(spark, sf, name):
    """One lambda in a generator or projection has Spark interpret the whole of it, row by row."""
    assert "lambda" not in plan(reconcile_queries.QUERIES[name][0](spark, sf)).lower()


def test_lines_are_sorted_by_their_hash_first_and_once(spark, sf):
    text = plan(reconcile_queries.bar_findings(spark, sf))
    assert text.count("Sort [_line") == text.count("Sort [") == 1


@pytest.mark.parametrize(("name", "exchanges"), [("bar_findings", 1), ("numeric_differences", 2), ("sanitized_findings", 2), ("first_findings", 1), ("segment_rollup", 2), ("shifted_pairs", 1)])
def test_a_comparison_shuffles_its_rows_once(spark, sf, name, exchanges):
    text = plan(reconcile_queries.QUERIES[name][0](spark, sf))
    assert text.count(" Exchange") == exchanges and text.count("FileScan") <= 6


def test_keys_expected_by_a_condition_are_those_of_a_frame(spark, sf):
    left, right = reconcile_queries.sides(spark, sf)
    by_frame = reconcile_queries.rb.compare_bars(left, right, reconcile_queries.CONFIG, reconcile_queries.expected(left))
    assert sorted(map(repr, by_frame.collect())) == sorted(map(repr, reconcile_queries.findings(spark, sf).collect()))


def test_findings_are_computed_once_by_code_that_is_compiled(spark, sf):
    text = plan(reconcile_queries.QUERIES["bar_findings"][0](spark, sf))
    assert text.count("likely_provider_issue") == 1


def test_evidence_stays_with_its_part_and_pages_are_parsed_once(spark, sf):
    text = plan(evidence_queries.page_evidence(spark, sf))
    assert text.count(" Exchange") == 2 and text.count("parseJson") == 1 and "Join" not in text and "schema_of_variant" not in text.split("Generate")[0]


def test_acceptance_reads_sums_alone(spark, sf):
    text = plan(pipeline_queries.acceptance(spark, sf))
    assert "tidemark-metrics" not in text and "issue_counts" not in text and "tidemark-outcome" in text
