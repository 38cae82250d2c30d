"""Sessions, expected keys, actions, reference data, raw pages and the stream."""

from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import reconcile_actions, reference_data, study
from tidemark.sources import raw


def dates(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "session_date date")


def study_sessions(spark):
    """The frozen study's calendar: two ranges of weekdays, five closed days, two extra ones, two early closes."""
    ranges = spark.createDataFrame([(date(2025, 5, 27), date(2025, 12, 6)), (date(2025, 1, 13), date(2025, 1, 29))], "a date, b date")
    closed = dates(spark, date(2025, 1, 20), date(2025, 6, 19), date(2025, 7, 4), date(2025, 9, 1), date(2025, 11, 27))
    early = spark.createDataFrame([(date(2025, 7, 3), datetime(2025, 7, 3, 17, tzinfo=UTC)), (date(2025, 11, 28), datetime(2025, 11, 28, 18, tzinfo=UTC))], "session_date date, close timestamp")
    return clock.sessions(clock.weekdays(ranges, "a", "b"), closed, dates(spark, date(2025, 3, 7), date(2025, 3, 10)), early)


# The days of the frozen study.
CALENDAR_DAYS = (date(2025, 3, 7), date(2025, 3, 10), date(2025, 7, 2), date(2025, 7, 3), date(2025, 10, 31), date(2025, 11, 3))
SPLIT_DAYS = {"A": (date(2025, 6, 9), date(2025, 6, 10)), "B": (date(2025, 6, 17), date(2025, 6, 18)), "C": (date(2025, 11, 14), date(2025, 11, 17))}
DAILY, TICKER = (datetime(2025, 5, 27, tzinfo=UTC), datetime(2025, 12, 6, tzinfo=UTC)), (datetime(2025, 1, 13, tzinfo=UTC), datetime(2025, 1, 21, tzinfo=UTC), datetime(2025, 1, 29, tzinfo=UTC))


def study_rules(spark):
    """22 windows over 16 instruments: two daily, six calendar days, twelve split boundaries, two tickers of one instrument."""
    rows = [(f"daily-core-{s}", segment, "all", "1d", state, *DAILY, None) for s, segment, state in (("raw", "daily", "unadjusted"), ("split", "daily_split", "split_adjusted"))]
    rows.append(("calendar", "calendar", "all", "5m", "unadjusted", None, None, list(CALENDAR_DAYS)))
    rows += [(f"split-{u}-{s}", segment, u, "5m", state, None, None, list(days)) for u, days in SPLIT_DAYS.items() for s, segment, state in (("raw", "split_raw", "unadjusted"), ("split", "split_adjusted", "split_adjusted"))]
    rows += [("ticker-old", "ticker", "old", "1d", "unadjusted", *TICKER[:2], None), ("ticker-new", "ticker", "new", "1d", "unadjusted", *TICKER[1:], None)]
    return spark.createDataFrame(rows, study.RULES)


def study_targets(spark):
    rows = [("all", f"S{i}", i) for i in range(16)] + [(u, f"S{i}", i) for i, u in enumerate(SPLIT_DAYS)] + [("old", "SQ", 0), ("new", "S0", 0)]
    return spark.createDataFrame(rows, "universe string, symbol string, instrument_id long")


def study_windows(spark, sessions):
    windows = study.study_windows(study_rules(spark), sessions)
    assert windows.count() == 22 and windows.select("label").distinct().count() == 22
    return study.window_targets(windows, study_targets(spark))


@pytest.mark.parametrize(("rule", "why"), [((None, None, [date(2025, 7, 4)]), "no session"), ((None, None, None), "bounds or session dates"), ((*DAILY, [date(2025, 7, 2)]), "bounds or session dates"), ((DAILY[1], DAILY[0], None), "empty window")])
def test_study_rules_are_checked(spark, rule, why):
    rules = spark.createDataFrame([("x", "s", "all", "5m", "unadjusted", *rule)], study.RULES)
    with pytest.raises(Exception, match=why):
        study.study_windows(rules, study_sessions(spark)).collect()


def test_frozen_study_has_148_sessions_and_12179_keys(spark):
    sessions = study_sessions(spark)
    assert sessions.count() == 148
    by_day = {r["session_date"]: r for r in sessions.withColumns({"s": F.date_format("start", "HH:mm"), "e": F.date_format("end", "HH:mm")}).collect()}
    assert (by_day[date(2025, 3, 7)]["s"], by_day[date(2025, 3, 10)]["s"]) == ("14:30", "13:30")
    assert by_day[date(2025, 7, 3)]["e"] == "17:00"
    windows = study_windows(spark, sessions)
    keys = clock.expected_keys(windows, sessions)
    assert {r["segment"]: r["count"] for r in keys.groupBy("segment").count().collect()} == {"daily": 2160, "daily_split": 2160, "calendar": 6912, "split_raw": 468, "split_adjusted": 468, "ticker": 11}
    assert clock.overlapping_keys(keys).count() == 0 and clock.misaligned_windows(windows, sessions).count() == 0


def test_misaligned_window_is_found(spark):
    sessions = study_sessions(spark)
    w = spark.createDataFrame([("x", 1, "5m", datetime(2025, 7, 2, 13, 31, tzinfo=UTC), datetime(2025, 7, 2, 14, 0, tzinfo=UTC))], "segment string, instrument_id long, timeframe string, start timestamp, end timestamp")
    assert clock.misaligned_windows(w, sessions).count() == 1


ACTION = "instrument_id string, action_type string, effective_date date, split_ratio decimal(18,8), amount decimal(18,8), currency string, old_ticker string, new_ticker string, raw_batch_id string"


def act(kind="split", day=date(2025, 6, 10), ratio=None, amount=None, currency=None, old=None, new=None, batch="b"):
    from decimal import Decimal

    return ("i", kind, day, ratio and Decimal(ratio), amount and Decimal(amount), currency, old, new, batch)


def actions(spark, left, right, **kw):
    found = reconcile_actions.compare_actions(spark.createDataFrame(left, ACTION), spark.createDataFrame(right, ACTION), **kw)
    return [(r["metric"], r["classification"]) for r in found.orderBy("effective_date", "ordinal").collect()]


def test_actions_compare_exactly_and_align_dates(spark):
    assert actions(spark, [act(ratio="2")], [act(ratio="3", day=date(2025, 6, 12))]) == [("effective_date", "unresolved_discrepancy"), ("split_ratio", "unresolved_discrepancy")]
    assert actions(spark, [act("dividend", amount="1.0", currency="USD")], [act("dividend", amount="1.1", currency="EUR")]) == [("dividend_amount", "unresolved_discrepancy"), ("currency", "unresolved_discrepancy")]
    assert actions(spark, [act("ticker_change", old="A", new="B")], [act("ticker_change", old="A", new="C")]) == [("new_ticker", "definitional_difference")]
    assert actions(spark, [act(ratio="2")], [act(ratio="2", day=date(2025, 6, 12)), act(ratio="2", day=date(2025, 6, 8))]) == [("availability", "missing_observation")] * 3
    assert actions(spark, [act(ratio="2")], [act(ratio="2", day=date(2025, 6, 18))]) == [("availability", "missing_observation")] * 2
    assert actions(spark, [act(ratio="2"), act(ratio="3")], [act(ratio="2")]) == [("duplicate_action", "likely_provider_issue")]
    with pytest.raises(ValueError):
        actions(spark, [act()], [act()], days=8)


def test_validity_is_half_open(spark):
    history = spark.createDataFrame([("a", "old", date(2025, 1, 1), date(2025, 2, 1)), ("a", "new", date(2025, 2, 1), None)], "owner string, name string, valid_from date, valid_to date")
    facts = spark.createDataFrame([("a", date(2025, 1, 31)), ("a", date(2025, 2, 1)), ("a", date(2024, 12, 31))], "owner string, day date")
    assert sorted((r["day"].isoformat(), r["name"]) for r in reference_data.as_of(facts, history, ["owner"], "day").collect()) == [("2025-01-31", "old"), ("2025-02-01", "new")]


def test_fingerprint_ignores_order(spark):
    rows = [("r", "i1", "A"), ("r", "i2", "B")]
    one, two = (reference_data.refs_fingerprint(spark.createDataFrame(x, "request_id string, instrument_id string, provider_identifier string")).first()["fingerprint"] for x in (rows, rows[::-1]))
    assert one == two


BATCH = "batch_id string, provider string, dataset string, endpoint string, retrieved_at timestamp, media_type string, request_metadata map<string,string>, payload binary"


def page(batch="b1", payload=b'{"a":1}', provider="P", meta=None):
    return (batch, provider, "bars", "/v2/bars", datetime(2025, 7, 2, tzinfo=UTC), "application/json", meta or {"page": "1"}, bytearray(payload))


def test_landing_is_once_and_collisions_fail(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([page(), page("b2")], BATCH)
    assert {r["landing"] for r in raw.land(df, root).collect()} == {"new"}
    assert {r["landing"] for r in raw.land(df, root).collect()} == {"replay"}
    assert spark.read.parquet(root).count() == 2
    assert raw.integrity_errors(spark.read.parquet(root)).count() == 0
    for other in (page(payload=b"{}"), page(provider="Q"), page(meta={"page": "2"})):
        with pytest.raises(raw.CollisionError):
            raw.land(spark.createDataFrame([other], BATCH), root)
    with pytest.raises(raw.CollisionError):
        raw.land(spark.createDataFrame([page("b3"), page("b3", b"{}")], BATCH), root)
    assert {r["landing"] for r in raw.land(spark.createDataFrame([page("b4"), page("b4")], BATCH), root).collect()} == {"new"}
    assert spark.read.parquet(root).count() == 3


def test_normalizers_take_bad_pages_as_batch_errors(spark):
    from tidemark.sources import normalize as nz

    cols = "raw_batch_id string, payload binary, request_id string, provider_identifier string, instrument_id string, source_id string, start_date date, end_date date"
    rows = [(f"b{k}", bytearray(x), "r", "A", "i", "s", date(2025, 1, 1), date(2026, 1, 1)) for k, x in enumerate((b"nope", b"[1]", b'{"status":"BAD"}', b'{"status":"OK"}', b'{"status":"OK","results":3}', b'{"status":"OK","results":[{"id":"1","ticker":"A","execution_date":"2025-07","adjustment_type":"forward_split","split_from":1,"split_to":4},{"id":"2","ticker":"A","execution_date":"2025-07-02","adjustment_type":"forward_split","split_from":3,"split_to":1}]}'))]
    out = nz.normalize_splits(spark.createDataFrame(rows, cols))
    assert sorted((r["raw_batch_id"], r["reason"]) for r in out.batch_errors.collect()) == [("b0", "invalid_json"), ("b1", "invalid_json"), ("b2", "status"), ("b4", "results")]
    assert [(r["code"], r["record_index"]) for r in out.issues.collect()] == [("malformed_record", 0)]
    assert str(out.rows.first()["split_ratio"]).startswith("0.33333333333333333333")


def test_symbol_order_of_the_document_numbers_records(spark):
    from tidemark.sources import normalize as nz

    body = b'{"bars":{"Z":[{"t":"2025-07-02T13:30:00Z","o":1,"h":1,"l":1,"c":1},{"t":"2025-07-02T13:35:00","o":1,"h":1,"l":1,"c":1}],"A":[{"t":"bad"}]}}'
    t = datetime(2025, 1, 1, tzinfo=UTC)
    pages = spark.createDataFrame([("b", bytearray(body), "r", "5m", t, datetime(2026, 1, 1, tzinfo=UTC), "regular", "unadjusted", True, "s", t, t)], "raw_batch_id string, payload binary, request_id string, timeframe string, start timestamp, end timestamp, session string, adjustment_state string, daily_verified boolean, source_id string, retrieved_at timestamp, ingested_at timestamp")
    refs = spark.createDataFrame([("r", "Z", "i")], "request_id string, provider_identifier string, instrument_id string")
    out = nz.normalize_symbol_map(pages, refs, study_sessions(spark))
    assert sorted((r["record_index"], r["code"]) for r in out.issues.collect()) == [(1, "malformed_record"), (2, "unmapped_instrument")]
    assert out.rows.count() == 1
