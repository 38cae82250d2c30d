"""Steps of the page flows that once took far more time or disk than their input."""

import json
import uuid
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.plans import normalize_queries as nq
from tidemark.plans import pipeline_queries
from tidemark.plans.flow import FlowError, process_pages
from tidemark.sources import normalize as nz
from tidemark.sources import raw
from tidemark.sources.store import BarStore
from tidemark.streaming.ingest import unpublished

START, END = datetime(2025, 7, 1, tzinfo=UTC), datetime(2025, 8, 1, tzinfo=UTC)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def calendar(spark):
    days = spark.sql("SELECT DATE'2025-07-01' AS a, DATE'2025-07-08' AS b")
    return clock.sessions(clock.weekdays(days, "a", "b"))


def pages_of(spark, bodies, timeframe="5m"):
    pages = spark.createDataFrame([(f"b{i}", bytearray(b.encode())) for i, b in enumerate(bodies)], "raw_batch_id string, payload binary")
    more = {"request_id": "r", "timeframe": timeframe, "start": START, "end": END, "session": "regular", "adjustment_state": "unadjusted", "daily_verified": True, "adjusted": False, "source_id": "s", "retrieved_at": END, "ingested_at": END}
    return pages.withColumns({k: F.lit(v) for k, v in more.items()})


@pytest.mark.parametrize("shape", sorted(nq.SHAPES))
def test_pages_are_normalized_by_compiled_code(spark, sf, shape):
    """a lambda has Spark interpret every record, and the order of the document is read for record_index alone."""
    x = nq.SHAPES[shape](spark, sf)
    text = plan(x.issues.groupBy("code", "severity").agg(F.count_distinct("raw_batch_id"))).lower()
    assert "lambda" not in text and "get_json_object" not in text and "json_object_keys" not in text and "jsonobjectkeys" not in text and "window" not in text


def test_record_indexes_follow_the_document(spark):
    """symbols in any order, one that holds no list, one with a record that is no object, and numbers of every kind."""
    rec = {"t": "2025-07-02T13:30:00Z", "o": 1.0, "h": 2, "l": "0.5", "c": 1.5e0}
    bodies = [
        json.dumps({"bars": {"Z": [rec, rec], "A": [rec], "M": [rec | {"v": "x"}]}}),
        json.dumps({"bars": {"Z": [rec, 5], "B": 7, "A": [rec, None], "C": None, "M": [rec | {"c": True}, rec | {"vw": 1e400}]}}).replace("Infinity", "1e400"),
        '{"bars": {"A": [], "A": []}}', '{"bars": [1]}', '[{"bars": {}}]', '{"bars": {}}',
    ]
    refs = spark.createDataFrame([("r", k, k.lower()) for k in "ABCZ"], "request_id string, provider_identifier string, instrument_id string")
    got = nz.normalize_symbol_map(pages_of(spark, bodies), refs, calendar(spark))
    found = [(r["raw_batch_id"], r["record_index"], r["code"], r["instrument_id"]) for r in got.outcome.filter("reason IS NULL").orderBy("raw_batch_id", "record_index").collect()]
    assert found == [
        ("b0", 0, None, "z"), ("b0", 1, None, "z"), ("b0", 2, None, "a"), ("b0", 3, "unmapped_instrument", None),
        ("b1", 0, None, "z"), ("b1", 1, "malformed_record", None), ("b1", 2, None, "a"), ("b1", 3, "malformed_record", None), ("b1", 4, "unmapped_instrument", None), ("b1", 5, "unmapped_instrument", None),
    ]
    assert sorted((r["raw_batch_id"], r["reason"]) for r in got.batch_errors.collect()) == [("b2", "invalid_json"), ("b3", "bars"), ("b4", "invalid_json")]
    assert {(r["open"], r["high"], r["low"], r["close"], r["volume"], r["vwap"]) for r in got.rows.collect()} == {(1.0, 2.0, 0.5, 1.5, None, None)}


def test_series_keep_the_order_of_the_document(spark):
    """symbols out of order, one that was not asked for, one absent, and a page of a single series."""
    one = lambda symbol, n, **more: {"meta": {"symbol": symbol, "interval": "1day"}, "values": [{"datetime": f"2025-07-0{k + 2}", "open": "1", "high": "2", "low": "1", "close": "1"} for k in range(n)], "status": "ok", **more}
    bodies = [json.dumps({"Z": one("Z", 2), "Q": one("Q", 1), "A": one("A", 1)}), json.dumps(one("A", 2)), json.dumps({"status": "error", "code": 400}), "{}", "{"]
    refs = spark.createDataFrame([("r", k, k.lower()) for k in "ABZ"], "request_id string, provider_identifier string, instrument_id string")
    pages = pages_of(spark, bodies, "1d").withColumn("chunk", F.array(F.lit("A"), F.lit("B"), F.lit("Z")))
    got = nz.normalize_series(pages, refs, calendar(spark))
    assert [(r["raw_batch_id"], r["record_index"], r["instrument_id"]) for r in got.outcome.filter("reason IS NULL AND code IS NULL").orderBy("raw_batch_id", "record_index").collect()] == [("b0", 0, "z"), ("b0", 1, "z"), ("b0", 2, "a"), ("b1", 0, "a"), ("b1", 1, "a")]
    issues = sorted((r["raw_batch_id"], r["code"], r["n"]) for r in got.issues.groupBy("raw_batch_id", "code").agg(F.count("*").alias("n")).collect())
    assert issues == [("b0", "provider_response_error", 1), ("b0", "unmapped_instrument", 1), ("b1", "provider_response_error", 2), ("b2", "provider_response_error", 4), ("b3", "provider_response_error", 3)]
    assert [(r["raw_batch_id"], r["reason"]) for r in got.batch_errors.collect()] == [("b4", "invalid_json")]


def batches_of(spark, n):
    rec = {"t": "2025-07-02T13:30:00Z", "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5}
    body = bytearray(json.dumps({"bars": {"AA": [rec]}}).encode())
    rows = [(f"00000000-0000-4000-8000-{i:012d}", "r", "00000000-0000-4000-8000-000000000009", "P", "bars", "/v2/bars", END, END, "application/json", {"page": "1"}, body) for i in range(n)]
    return spark.createDataFrame(rows, "batch_id string, request_id string, source_id string, provider string, dataset string, endpoint string, retrieved_at timestamp, ingested_at timestamp, media_type string, request_metadata map<string,string>, payload binary")


def flow_of(spark, batches, tmp_path, store):
    row = ("r", "00000000-0000-4000-8000-000000000009", None, "5m", START, END, "regular", "unadjusted", True)
    requests = spark.createDataFrame([row], "request_id string, source_id string, expected_metadata map<string,string>, timeframe string, start timestamp, end timestamp, session string, adjustment_state string, daily_verified boolean")
    refs = spark.createDataFrame([("r", "AA", "00000000-0000-4000-8000-000000000002")], "request_id string, provider_identifier string, instrument_id string")
    return process_pages(batches, requests, "symbol_map", refs, calendar(spark), str(tmp_path / "raw"), store)


def test_a_flow_computes_its_batches_once(spark, tmp_path):
    """batches were computed anew by each step that asked for their ids or payloads."""
    reads = tmp_path / "reads"
    reads.mkdir()

    def passing(batches):
        (reads / uuid.uuid4().hex).write_text("x")
        yield from batches

    batches = batches_of(spark, 3).coalesce(1)
    done = flow_of(spark, batches.mapInArrow(passing, batches.schema), tmp_path, BarStore(spark, str(tmp_path / "bars")))
    assert [(r["rows"], r["replayed"], r["stored_pass"]) for r in done.metrics.collect()] == [(1, False, True)] * 3
    assert len(list(reads.iterdir())) == 1


def test_a_flow_reads_its_own_batches_back(spark, tmp_path, monkeypatch):
    """other batches of the root and the store are left out, and bars that come back otherwise fail the call."""
    store, all_of = BarStore(spark, str(tmp_path / "bars")), batches_of(spark, 5)
    flow_of(spark, all_of.filter("batch_id < '00000000-0000-4000-8000-000000000002'"), tmp_path, store)
    more = flow_of(spark, all_of.filter("batch_id >= '00000000-0000-4000-8000-000000000002'").limit(2), tmp_path, store)
    assert len(more.metrics.collect()) == 2 and store.query().count() == 4
    rest = all_of.filter("batch_id = '00000000-0000-4000-8000-000000000004'")
    back = BarStore.batches_read
    monkeypatch.setattr(BarStore, "batches_read", lambda self, ids: back(self, ids).withColumn("open", F.col("open") + 1))
    with pytest.raises(FlowError, match="other bars"):
        flow_of(spark, rest, tmp_path, store)


def test_landing_shuffles_no_payload(spark, tmp_path):
    """a batch that comes twice is landed once, and one that comes again is a replay."""
    batches, root = batches_of(spark, 3), str(tmp_path / "raw")
    assert {tuple(r) for r in raw.land(batches.unionByName(batches.limit(1)), root).select("landing").collect()} == {("new",)}
    assert spark.read.parquet(root).count() == 3
    assert sorted(r["landing"] for r in raw.land(batches_of(spark, 4), root).collect()) == ["new", "replay", "replay", "replay"]
    assert spark.read.parquet(root).count() == 4
    other = batches.withColumn("endpoint", F.lit("/v3/bars"))
    with pytest.raises(raw.CollisionError):
        raw.land(other, root)
    with pytest.raises(raw.CollisionError):
        raw.land(batches_of(spark, 7).filter("batch_id > '00000000-0000-4000-8000-000000000004'").unionByName(other.withColumn("batch_id", F.lit("x"))).unionByName(batches.withColumn("batch_id", F.lit("x"))), root)
    text = plan(raw.classify_landing(batches, spark.read.parquet(root)))
    assert "Expand" not in text and "SortAggregate" not in text


def test_pages_meet_the_registry_only_if_it_holds_some(spark, tmp_path):
    """payloads were shuffled to meet a registry that held none of their batches."""
    store, batches = BarStore(spark, str(tmp_path / "bars")), batches_of(spark, 4)
    assert "Join" not in plan(unpublished(batches, store, "batch_id"))
    flow_of(spark, batches.filter("batch_id < '00000000-0000-4000-8000-000000000002'"), tmp_path, store)
    later = batches.filter("batch_id >= '00000000-0000-4000-8000-000000000002'")
    assert "Join" not in plan(unpublished(later, store, "batch_id")) and unpublished(later, store, "batch_id").count() == 2
    assert sorted(r["batch_id"][-1] for r in unpublished(batches, store, "batch_id").collect()) == ["2", "3"]


def test_metrics_write_only_what_they_read(spark, sf, tmp_path, monkeypatch):
    """the whole outcome was written, with indexes that need a window over each page, and bars beside each issue."""
    paths = []
    monkeypatch.setattr(pipeline_queries, "scratch_folder", lambda spark, name: paths.append(str(tmp_path / f"{name}-{len(paths)}")) or paths[-1])
    pipeline_queries._metrics(spark, sf)
    assert len(paths) == 2
    for p in paths:
        written = spark.read.parquet(p)
        assert not {"record_index", "message", "provider_record_id"} & set(written.columns)
        assert written.filter("code IS NOT NULL").select(F.count_if(F.coalesce("instrument_id", F.col("open").cast("string"), F.col("timestamp_start").cast("string")).isNotNull())).first()[0] == 0


def test_columns_left_out_are_null(spark, sf, tmp_path):
    """rows, issues and errors are the same but for these columns."""
    whole = nq.SHAPES["series"](spark, sf)
    few = nz.stored(whole, str(tmp_path / "few"), ("record_index", "currency"))
    assert few.rows.schema == whole.rows.schema and few.issues.columns == whole.issues.columns
    key = ["raw_batch_id", "instrument_id", "timestamp_start", "open"]
    assert sorted(map(str, few.rows.select(*key).collect())) == sorted(map(str, whole.rows.select(*key).collect()))
    assert few.rows.filter("currency IS NOT NULL").isEmpty() and few.issues.filter("record_index IS NOT NULL").isEmpty()
    assert few.issues.groupBy("code").count().orderBy("code").collect() == whole.issues.groupBy("code").count().orderBy("code").collect()


def test_a_summary_counts_no_codes_that_it_does_not_show(spark, sf, tmp_path, monkeypatch):
    """issues were counted by batch and code, and written, for a map that the summary leaves out."""
    paths = []
    monkeypatch.setattr(pipeline_queries, "scratch_folder", lambda spark, name: paths.append(str(tmp_path / name / str(len(paths)))) or paths[-1])
    found = pipeline_queries.pipeline_summary(spark, sf)
    assert "issue_counts" not in spark.read.parquet(next(p for p in paths if "metrics" in p)).columns and "issue_counts" not in plan(found)
    assert {r["shape"]: r["flag_counts"] != "" for r in found.collect()}.keys() == {"symbol_map", "series"}
