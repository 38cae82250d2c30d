"""Metrics of batches and providers, evidence from raw pages, constraints and what may leave a run."""

import json
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import constraints, metrics
from tidemark.operators.validation import validate_bars
from tidemark.plans import adapters
from tidemark.sources import raw
from tidemark.sources.store import BarQuery


def test_evidence_comes_from_raw_pages_and_the_last_readable_record_wins(spark):
    bar = lambda t, o, **more: {"t": t, "o": o, "h": 3, "l": 1, "c": 2, **more}
    text = lambda t, o: {"datetime": t, "open": o, "high": "3", "low": "1", "close": "2"}
    pages = [
        ("a", "raw", "X", 1, {"bars": {"X": [bar("2025-06-09T13:30:00Z", 1), bar("2025-06-09T13:35:00Z", 1.5), bar("2025-06-10T13:30:00Z", 9), bar("2025-06-11", True), {"t": 5}]}}),
        ("a", "raw", "X", 2, {"bars": {"X": [bar("2025-06-10T13:35:00Z", 7)], "Y": [bar("2025-06-12", 1)]}}),
        ("b", "raw", "X", 1, {"values": [text("2025-06-09 09:30:00", "1.5"), text("2025-06-10 09:30:00", "nope")]}),
        ("b", "split", "X", 1, {"X": {"values": [text("2025-06-09", "2.5")]}}),
        ("b", "none", "X", 1, {"X": 3}),
    ]
    rows = spark.createDataFrame([(*p[:4], bytearray(json.dumps(p[4]).encode())) for p in pages], "provider string, adjustment string, symbol string, page_number int, payload binary")
    found = metrics.evidence_series(rows, ["provider", "adjustment"])
    assert {(r["provider"], r["adjustment"], r["day"]): r["v"]["open"] for r in found.collect()} == {("a", "raw", "2025-06-09"): 1.5, ("a", "raw", "2025-06-10"): 7.0, ("b", "raw", "2025-06-09"): 1.5, ("b", "split", "2025-06-09"): 2.5}
    base = found.filter("adjustment = 'raw'").drop("adjustment")
    got = metrics.compared_series(found, base, ["provider", "adjustment"], ["provider", "day"]).collect()
    assert {(r["provider"], r["adjustment"]): (r["compared"], r["different"]) for r in got} == {("a", "raw"): (2, 0), ("b", "raw"): (1, 0), ("b", "split"): (1, 1)}


def test_provider_summary_merges_count_maps(spark):
    schema = "provider string, bytes long, rows long, issues long, errors long, flags long, parts long, passed boolean, latency_ms double, rate_limit_remaining double, api_credits_used double, issue_counts map<string,long>, flag_counts map<string,long>"
    rows = [("p", 1, 2, 3, 0, 1, 1, True, 5.0, 9.0, None, {"b": 1, "a": 2}, {"f": 1}), ("p", 1, 0, 1, 0, 0, 0, False, None, 4.0, 2.0, {"a": 1}, {}), ("q", 1, 1, 0, 0, 0, 1, True, None, None, None, {}, {})]
    got = {r["provider"]: r for r in metrics.pipeline_summary(spark.createDataFrame(rows, schema), "provider").collect()}
    p, q = got["p"], got["q"]
    assert (p["issue_counts"], p["flag_counts"], p["latencies"], p["latency_max"], p["remaining_min"], p["credits_max"], p["pipeline_pass"]) == ({"a": 3, "b": 1}, {"f": 1}, 1, 5.0, 4.0, 2.0, False)
    assert (q["issue_counts"], q["pipeline_pass"], q["latencies"], q["remaining_min"]) == ({}, True, 0, None)


def test_action_summary_counts_types_issues_and_pages(spark):
    pages = spark.createDataFrame([("p", bytearray(b"12345"), {"latency_ms": "7.5"}), ("p", bytearray(b"1"), {"latency_ms": "NaN"})], "provider string, payload binary, request_metadata map<string,string>")
    actions = spark.createDataFrame([("p", "split"), ("p", "dividend"), ("p", "split")], "provider string, action_type string")
    issues = spark.createDataFrame([("p", "malformed_record")], "provider string, code string")
    r = metrics.action_summary(pages, actions, issues).first()
    assert (r["pages"], r["bytes"], r["latency_max"], r["actions"], r["type_counts"], r["issue_counts"]) == (2, 6, 7.5, 3, {"dividend": 1, "split": 2}, {"malformed_record": 1})


def test_results_leave_without_ids_and_values(spark, tmp_path):
    fine = spark.createDataFrame([("p", 1)], "provider string, rows long")
    with pytest.raises(ValueError):
        metrics.write_results({"fine": fine, "other": fine.withColumn("left_number", F.lit(1.0))}, str(tmp_path))
    assert not list(tmp_path.iterdir())
    metrics.write_results({"fine": fine}, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/fine").count() == 1


def test_headers_count_whatever_their_case_and_the_body_names_the_request(spark):
    rows = [({"X-RateLimit-Limit": "10", "x-ratelimit-limit": "10", "Retry-After": "-1", "X-Request-Id": "a b", "APCA-Request-ID": "ok"}, b"{}"), ({}, b'{"request_id": 12}'), ({}, b'{"request_id": 1.5}'), (None, b"no")]
    df = spark.createDataFrame([(i, h, bytearray(b), 0.0123456) for i, (h, b) in enumerate(rows)], "i int, headers map<string,string>, body binary, elapsed_s double")
    got = raw.enriched(df).orderBy("i").collect()
    assert [r["request_id"] for r in got] == ["ok", "12", None, None]
    assert (got[0]["rate_limit_capacity"], got[0]["retry_after_s"], got[0]["latency_ms"]) == (10.0, None, 12.346)


def test_runtime_summary_refuses_another_provider(spark):
    df = spark.createDataFrame([("P", "d", {"rate_limit_capacity": "5"}), ("p", "d", {"latency_ms": "1"})], "provider string, dataset string, request_metadata map<string,string>")
    assert raw.runtime_summary(df, " p ").first()["capacities"] == "5"
    with pytest.raises(Exception, match="another provider"):
        raw.runtime_summary(df, "q").collect()


def test_blank_flags_fail_and_ids_of_a_query_are_canonical(spark, sf):
    bars = adapters.bars(spark, sf).withColumn("quality_flags", F.array(F.lit(" ")))
    with pytest.raises(Exception, match="null or blank"):
        validate_bars(bars).select("quality_flags").collect()
    assert BarQuery(instruments=("{00000000-0000-4000-8001-00000000000A}",)).instruments == ("00000000-0000-4000-8001-00000000000a",)
    with pytest.raises(ValueError):
        BarQuery(sources=("x",))


def test_constraints_of_sessions_and_keys_in_order(spark):
    at = lambda *x: datetime(*x, tzinfo=UTC)
    rows = [(date(2025, 7, 2), at(2025, 7, 2, 13, 30), at(2025, 7, 2, 20), "c"), (date(2025, 7, 3), at(2025, 7, 3, 13, 30), at(2025, 7, 4, 5), " "), (date(2025, 7, 4), at(2025, 7, 4, 1), at(2025, 7, 4, 2), "c")]
    s = spark.createDataFrame(rows, "session_date date, start timestamp, end timestamp, source string")
    found = {(r["session_date"].day, r["rule"]) for r in constraints.session_violations(s).collect()}
    assert found == {(3, "blank_source"), (3, "ends_on_another_date"), (4, "starts_on_another_date"), (4, "ends_on_another_date")}
    w = spark.createDataFrame([("x", k, "5m", at(2025, 7, 2, 13, 30), at(2025, 7, 2, 14)) for k in (2, 1)], "segment string, instrument_id long, timeframe string, start timestamp, end timestamp")
    keys = [tuple(r) for r in clock.ordered_keys(clock.expected_keys(w, s)).collect()]
    assert len(keys) == 12 and keys == sorted(keys)
