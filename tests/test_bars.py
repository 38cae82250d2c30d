"""Validation, coercion, storage and comparison of bars on small frames."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import canonical, reconcile_bars, validation
from tidemark.schemas import BAR_SCHEMA
from tidemark.sources.store import BarQuery, BarStore

T0 = datetime(2025, 7, 2, 13, 30, tzinfo=UTC)
U = "00000000-0000-4000-8000-0000000000{:02d}".format


def bar(start=T0, minutes=5, o=10.0, h=11.0, low=9.0, c=10.5, v=100.0, vwap=10.2, timeframe="5m", session="regular", adj="unadjusted", currency="USD", instrument=U(1), source=U(2), batch=U(3), flags=()):
    return (instrument, timeframe, start, start + timedelta(minutes=minutes), o, h, low, c, v, vwap, currency, session, adj, source, batch, None, None, start, start + timedelta(hours=1), list(flags))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BAR_SCHEMA)


def flags_of(df):
    return [r["quality_flags"] for r in df.orderBy("timestamp_start", "low").collect()]


def test_flags_come_in_rule_order_after_others_and_validation_is_idempotent(spark):
    df = frame(spark, bar(), bar(h=8.0, v=-1.0, low=-1.0, c=9.0), bar(start=T0 + timedelta(minutes=5), minutes=4, vwap=0.0, flags=["upstream", " upstream ", "negative_volume"]))
    once = validation.validate_bars(df)
    assert flags_of(once) == [["ohlc_inconsistent", "negative_volume", "duplicate_bar", "non_positive_price"], ["duplicate_bar"], ["upstream", "non_positive_price", "unexpected_duration"]]
    assert flags_of(validation.validate_bars(once)) == flags_of(once)
    counts = {r["flag"]: r["rows"] for r in validation.flag_counts(once).collect()}
    assert counts == {"ohlc_inconsistent": 1, "negative_volume": 1, "duplicate_bar": 2, "non_positive_price": 2, "unexpected_duration": 1}


def test_policy_switches_price_rule_and_duplicate_scope(spark):
    df = frame(spark, bar(low=-1.0), bar(batch=U(4)))
    quiet = validation.validate_bars(df, validation.ValidationPolicy(check_non_positive_prices=False, duplicate_scope="batch"))
    assert flags_of(quiet) == [[], []]


def test_null_volume_and_vwap_raise_no_flag(spark):
    assert flags_of(validation.validate_bars(frame(spark, bar(v=None, vwap=None)))) == [[]]


@pytest.mark.parametrize("change", [{"h": float("inf")}, {"instrument": "nope"}, {"flags": [" "]}, {"timeframe": "1h"}, {"session": "lunch"}, {"minutes": 0}])
def test_coercion_rejects(spark, change):
    with pytest.raises(canonical.CanonicalError):
        canonical.coerce(frame(spark, bar(**change)))


def test_coercion_rejects_column_sets_and_zoneless_times(spark):
    df = frame(spark, bar())
    with pytest.raises(canonical.CanonicalError, match="extra"):
        canonical.coerce(df.withColumn("x", F.lit(1)))
    with pytest.raises(canonical.CanonicalError, match="zone"):
        canonical.coerce(df.withColumn("timestamp_start", F.col("timestamp_start").cast("timestamp_ntz")))


def test_coercion_canonicalizes_ids_and_sorts_flags(spark):
    row = canonical.coerce(frame(spark, bar(instrument="{" + U(1).upper() + "}", flags=["z", " a "]))).first()
    assert row["instrument_id"] == U(1) and row["quality_flags"] == ["a", "z"]


def test_store_roundtrip_refuses_published_batches(spark, tmp_path):
    store = BarStore(spark, str(tmp_path / "bars"))
    assert store.query().count() == 0
    both = frame(spark, bar(flags=["b", "a"]), bar(start=datetime(2025, 8, 1, 13, 30, tzinfo=UTC)))
    store.append(both)
    assert canonical.frames_match(both, store.query())
    assert [r["timeframe"] for r in store.query(BarQuery(start=datetime(2025, 8, 1, tzinfo=UTC))).collect()] == ["5m"]
    with pytest.raises(canonical.CanonicalError, match="published"):
        store.append(both)
    with pytest.raises(canonical.CanonicalError, match="no bars"):
        store.append(both.limit(0))
    with pytest.raises(canonical.CanonicalError, match="another"):
        store.append(frame(spark, bar(batch=U(9))), spark.createDataFrame([(U(8),)], "raw_batch_id string"))


def test_query_bounds_are_checked():
    with pytest.raises(ValueError):
        BarQuery(start=datetime(2025, 1, 1))
    with pytest.raises(ValueError):
        BarQuery(timeframe="1h")
    with pytest.raises(ValueError):
        BarQuery(start=T0, end=T0)


def compare(left, right, expected=None, **config):
    found = reconcile_bars.compare_bars(left, right, reconcile_bars.BarComparison("a", "b", **config), expected)
    return [(r["metric"], r["classification"]) for r in found.orderBy("timestamp_start", "ordinal").collect()]


def test_values_within_tolerance_are_equal_and_others_are_classified(spark):
    left = frame(spark, bar())
    assert compare(left, frame(spark, bar(c=10.5 + 1e-10))) == []
    assert compare(left, frame(spark, bar(c=10.6, v=99.0)), venue_metrics=frozenset({"volume"})) == [("close", "unresolved_discrepancy"), ("volume", "venue_feed_difference")]
    assert compare(left, frame(spark, bar(c=10.6, adj="split_adjusted", session="unknown"))) == [("session", "timing_session_difference"), ("adjustment", "adjustment_difference"), ("close", "adjustment_difference")]
    assert compare(left, frame(spark, bar(c=10.6, v=99.0)), excluded_metrics=frozenset({"close", "volume"})) == []
    assert compare(left, frame(spark, bar(currency=None, vwap=None))) == [("currency", "definitional_difference"), ("vwap", "unresolved_discrepancy")]


def test_a_shift_of_a_minute_is_aligned_and_two_minutes_are_not(spark):
    left = frame(spark, bar())
    assert compare(left, frame(spark, bar(start=T0 + timedelta(minutes=1)))) == [("interval_boundary", "timing_session_difference")]
    assert compare(left, frame(spark, bar(start=T0 + timedelta(minutes=2)))) == [("availability", "missing_observation")] * 2
    both = frame(spark, bar(start=T0 + timedelta(minutes=1)), bar(start=T0 - timedelta(minutes=1)))
    assert compare(left, both) == [("availability", "missing_observation")] * 3


def test_duplicates_stop_a_key_and_expected_keys_appear(spark):
    left = frame(spark, bar(), bar(c=1.0))
    expected = frame(spark, bar(start=T0 + timedelta(minutes=30))).select("instrument_id", "timeframe", "timestamp_start")
    assert compare(left, frame(spark, bar()), expected) == [("duplicate_bar", "likely_provider_issue"), ("availability", "missing_observation")]


def test_configuration_is_checked():
    for bad in (("a", " A "), ("", "b")):
        with pytest.raises(ValueError):
            reconcile_bars.BarComparison(*bad)
    with pytest.raises(ValueError):
        reconcile_bars.BarComparison("a", "b", venue_metrics=frozenset({"session"}))
    with pytest.raises(ValueError):
        reconcile_bars.BarComparison("a", "b", venue_metrics=frozenset({"volume"}), excluded_metrics=frozenset({"volume"}))


def test_empty_sides(spark):
    empty = canonical.empty_bars(spark)
    assert compare(empty, empty) == []
    assert compare(frame(spark, bar()), empty) == [("availability", "missing_observation")]
    assert {r["findings"] for r in reconcile_bars.counts_by_class(reconcile_bars.compare_bars(empty, empty, reconcile_bars.BarComparison("a", "b"))).collect()} == {0}


def test_shifted_matching_agrees_with_brute_force(spark):
    import random

    from tidemark.operators.matching import mutually_unique_pairs

    rng = random.Random(7)
    a = [(rng.randrange(3), rng.randrange(0, 400)) for _ in range(60)]
    b = [(rng.randrange(3), rng.randrange(0, 400)) for _ in range(60)]
    a, b = sorted(set(a)), sorted(set(b))
    near = [(k, x, y) for k, x in a for j, y in b if k == j and 0 < abs(x - y) <= 7]
    want = sorted(p for p in near if sum(q[:2] == p[:2] for q in near) == 1 and sum((q[0], q[2]) == (p[0], p[2]) for q in near) == 1)
    left, right = (spark.createDataFrame(x, "k long, at long") for x in (a, b))
    assert sorted(map(tuple, mutually_unique_pairs(left, right, ["k"], "at", 7).collect())) == want
    assert mutually_unique_pairs(left, right, ["k"], "at", 0).count() == 0


def test_frames_differ_as_multisets_of_rows(spark):
    empty_bars, frame_differences, frames_match = canonical.empty_bars, canonical.frame_differences, canonical.frames_match
    bars = frame(spark, *(bar(o=float(i), vwap=None if i == 2 else 1.0) for i in range(3)))
    a = bars.withColumn("quality_flags", F.array(F.lit("y"), F.lit("x")))
    b = bars.withColumn("quality_flags", F.array(F.lit("x"), F.lit("y")))
    assert frames_match(a, b) and not frames_match(a, bars)
    assert sorted(r["surplus"] for r in frame_differences(a.unionByName(a), b).collect()) == [1, 1, 1]
    assert sorted(r["surplus"] for r in frame_differences(a, b.unionByName(b).unionByName(b)).collect()) == [-2, -2, -2]
    assert frames_match(empty_bars(spark), empty_bars(spark)) and frame_differences(empty_bars(spark), a).count() == 3
    plan = frame_differences(a, b)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_frames_meet_by_digests_where_few_columns_are_shown(spark):
    rows = [bar(vwap=None, v=1.0), bar(vwap=1.0, v=None), bar(flags=["a"]), bar(flags=["a", "a"]), bar(o=-0.0), bar(o=0.0), bar()]
    a, b = frame(spark, *rows[:5]), frame(spark, *rows[1:])
    few = canonical.frame_differences(a, b, shown=("timeframe",))
    assert few.columns == ["timeframe", "surplus"]
    assert sorted(r["surplus"] for r in few.collect()) == sorted(r["surplus"] for r in canonical.frame_differences(a, b).collect()) == [-1, -1, 1]
    assert "vwap" not in few._jdf.queryExecution().executedPlan().toString().split("Exchange")[0]


@pytest.mark.parametrize("text", [U(1), "{" + U(1).upper() + "}", "\tURN:UUID:" + U(1) + " \n", U(1).replace("-", ""), U(1)[:-1], U(1) + "0", "g" * 32, "", None, "{" + U(1) + "}\u2028"])
def test_spellings_of_ids(spark, text):
    from tidemark.functions.text import canonical_uuid

    df = spark.createDataFrame([(text,)], "c string").select(canonical_uuid(F.col("c")).alias("u"))
    good = text is not None and text.strip().lower().removeprefix("urn:uuid:").replace("-", "").strip("{}") == U(1).replace("-", "") and not text.endswith("\u2028")
    assert df.first()["u"] == (U(1) if good else None)
    assert "rlike" not in df._jdf.queryExecution().executedPlan().toString().lower() and "regexp" not in df._jdf.queryExecution().executedPlan().toString().lower()
