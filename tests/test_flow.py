"""Pages through the whole flow, request binding, chunk manifests, endpoints and ids."""

import json
import uuid
from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.functions.text import name_uuid, slug
from tidemark.plans.flow import process_pages
from tidemark.sources import normalize, raw
from tidemark.sources import normalize as nz
from tidemark.sources.store import BarStore

U = "00000000-0000-4000-8000-0000000000{:02d}".format
START, END = datetime(2025, 7, 1, tzinfo=UTC), datetime(2025, 8, 1, tzinfo=UTC)


def sessions(spark):
    days = spark.createDataFrame([(date(2025, 7, 1), date(2025, 7, 8))], "a date, b date")
    return clock.sessions(clock.weekdays(days, "a", "b"))


BATCH = "batch_id string, request_id string, source_id string, provider string, dataset string, endpoint string, retrieved_at timestamp, ingested_at timestamp, media_type string, request_metadata map<string,string>, payload binary"


def a_batch(n, records, request="r", source=None, page="1"):
    body = json.dumps({"bars": records}).encode()
    return (U(n), request, source or U(9), "P", "bars", "/v2/bars", datetime(2025, 7, 3, tzinfo=UTC), datetime(2025, 7, 3, tzinfo=UTC), "application/json", {"page_number": page}, bytearray(body))


def rec(t, h=2.0):
    return {"t": t, "o": 1.0, "h": h, "l": 0.5, "c": 1.5, "v": -1}


def requests(spark):
    row = ("r", U(9), None, "5m", START, END, "regular", "unadjusted", True)
    return spark.createDataFrame([row], "request_id string, source_id string, expected_metadata map<string,string>, timeframe string, start timestamp, end timestamp, session string, adjustment_state string, daily_verified boolean")


def references(spark):
    return spark.createDataFrame([("r", "AA", U(2))], "request_id string, provider_identifier string, instrument_id string")


RECORDS = {"AA": [rec("2025-07-02T13:30:00Z", 0.1), rec("2025-07-02T13:30:00Z"), rec("2025-07-02T20:00:00Z")], "ZZ": [rec("2025-07-02T13:30:00Z")]}
ONE = {"AA": [rec("2025-07-02T13:35:00Z")]}


def test_pages_land_normalize_store_and_read_back(spark, tmp_path):
    batches = spark.createDataFrame([a_batch(1, RECORDS), a_batch(3, ONE, request="unknown"), a_batch(4, ONE, source=U(8)), a_batch(5, {}), a_batch(6, [])], BATCH)
    store = BarStore(spark, str(tmp_path / "bars"))
    done = process_pages(batches, requests(spark), "symbol_map", references(spark), sessions(spark), str(tmp_path / "raw"), store)
    m = {r["raw_batch_id"]: r for r in done.metrics.collect()}
    assert set(m) == {U(k) for k in (1, 3, 4, 5, 6)}
    first = m[U(1)]
    assert (first["rows"], first["issues"], first["errors"], first["flags"], first["passed"], first["replayed"], first["normalization_pass"], first["stored_pass"]) == (2, 2, 1, 5, False, False, False, True)
    assert [(m[U(k)]["rows"], m[U(k)]["errors"], m[U(k)]["normalization_pass"]) for k in (3, 4, 5, 6)] == [(0, 1, False), (0, 1, False), (0, 0, True), (0, 1, False)]
    assert sorted((r["raw_batch_id"], r["reason"]) for r in done.batch_errors.collect()) == [(U(3), "request"), (U(4), "source"), (U(6), "bars")]
    assert sorted((r["code"], r["record_index"], r["severity"]) for r in done.issues.collect()) == [("outside_requested_session", 2, "warning"), ("unmapped_instrument", 3, "error")]
    assert {r["message"] for r in done.issues.collect()} == {"the bar lies outside the session", "the symbol isn't one of the request"}
    assert sorted(map(tuple, (r["quality_flags"] for r in store.query().collect()))) == [("duplicate_bar", "negative_volume"), ("duplicate_bar", "negative_volume", "ohlc_inconsistent")]
    assert [tuple(r) for r in store.published_batches().collect()] == [(U(1), 2)]


def bars_of(spark, tmp_path, *batches):
    pages = spark.createDataFrame(list(batches), BATCH).withColumn("raw_batch_id", F.col("batch_id"))
    return nz.normalize_symbol_map(nz.bind(pages, requests(spark)), references(spark), sessions(spark)).rows


def test_an_append_that_dies_before_its_commit_shows_nothing_and_runs_again(spark, tmp_path, monkeypatch):
    store = BarStore(spark, str(tmp_path / "bars"))
    store.append(bars_of(spark, tmp_path, a_batch(1, ONE)), publish_id="one")
    more = bars_of(spark, tmp_path, a_batch(3, RECORDS))

    def dies(self, publish):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(BarStore, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            store.append(more, publish_id="two")
    assert (tmp_path / "bars/data/publish=two").exists() and store.query().count() == 1 and store.published_batches().count() == 1
    assert store.append(more, publish_id="two") and store.query().count() == 3
    assert not store.append(more, publish_id="two") and store.query().count() == 3  # a repeated publish changes nothing
    with pytest.raises(Exception, match="published"):
        store.append(more, publish_id="three")
    assert store.publishes() == ["one", "two"] and not (tmp_path / "bars/data/publish=three").exists()
    with pytest.raises(ValueError, match="publish id"):
        store.append(more, publish_id="../x")


def test_an_append_reads_its_input_once(spark, tmp_path):
    reads = tmp_path / "reads"
    reads.mkdir()

    def passing(batches):
        rows = list(batches)
        (reads / uuid.uuid4().hex).write_text("x")
        yield from rows

    bars = bars_of(spark, tmp_path, a_batch(1, RECORDS)).coalesce(1)
    BarStore(spark, str(tmp_path / "bars")).append(bars.mapInArrow(passing, bars.schema))
    assert len(list(reads.iterdir())) == 1


def test_landed_pages_stream_once_however_often_a_micro_batch_runs(spark, tmp_path, monkeypatch):
    from tidemark.plans.flow import bound_normalizer
    from tidemark.streaming.ingest import ingest_available, ingested

    root, store = str(tmp_path / "raw"), BarStore(spark, str(tmp_path / "bars"))
    normalizer = bound_normalizer("symbol_map", requests(spark), references(spark), sessions(spark))
    raw.land(spark.createDataFrame([a_batch(1, RECORDS), a_batch(3, ONE, request="unknown")], BATCH), root)
    schema = spark.read.parquet(root).schema

    def run():
        ingest_available(spark, root, schema, normalizer, store, str(tmp_path / "checkpoint"), str(tmp_path / "side"))

    commit = BarStore._commit
    with monkeypatch.context() as m:
        m.setattr(BarStore, "_commit", lambda self, publish: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert store.query().count() == 0
    with monkeypatch.context() as m:  # the commit works, but the stream dies before it can note it

        def then_dies(self, publish):
            commit(self, publish)
            raise RuntimeError("lost later")

        m.setattr(BarStore, "_commit", then_dies)
        with pytest.raises(Exception, match="lost later"):
            run()
    assert store.query().count() == 2
    raw.land(spark.createDataFrame([a_batch(4, ONE)], BATCH), root)
    run()
    run()
    assert store.query().count() == 3 and store.publishes() == ["stream-0", "stream-1"]
    found = ingested(spark, str(tmp_path / "side"), normalizer(spark.read.parquet(root)).outcome.schema)
    assert found.rows.count() == 3 and [tuple(r) for r in found.batch_errors.collect()] == [(U(3), "request")] and found.issues.count() == 2


def test_chunk_manifests_bind_series_pages(spark):
    import hashlib

    good = json.dumps({"version": 1, "references": [{"instrument_id": U(2), "provider_identifier": "AA"}, {"instrument_id": U(4), "provider_identifier": "BB"}]})
    other = json.dumps({"version": 1, "references": [{"instrument_id": U(7), "provider_identifier": "AA"}]})
    body = json.dumps({"AA": {"meta": {"symbol": "AA", "interval": "5min", "currency": "USD"}, "values": [{"datetime": "2025-07-02 13:30:00", "open": "1", "high": "2", "low": "1", "close": "1.5", "volume": "3"}], "status": "ok"}})
    mark = lambda t: hashlib.sha256(t.encode()).hexdigest()
    rows = [("a", good, mark(good)), ("b", good, mark(other)), ("c", other, mark(other)), ("d", '{"version":2}', mark('{"version":2}')), ("e", None, None)]
    pages = spark.createDataFrame(rows, "raw_batch_id string, manifest_chunk string, chunk_fingerprint string")
    pages = pages.withColumns({"payload": F.encode(F.lit(body), "UTF-8"), "request_id": F.lit("r"), "timeframe": F.lit("5m"), "start": F.lit(START), "end": F.lit(END), "session": F.lit("regular"), "adjustment_state": F.lit("unadjusted"), "daily_verified": F.lit(True), "source_id": F.lit("s"), "retrieved_at": F.lit(END), "ingested_at": F.lit(END)})
    pages = pages.withColumn("request_references", F.array(*(F.struct(F.lit(U(i)).alias("instrument_id"), F.lit(p).alias("provider_identifier")) for i, p in ((2, "AA"), (4, "BB"), (5, "CC")))))
    refs = spark.createDataFrame([("r", "AA", U(2)), ("r", "BB", U(4)), ("r", "CC", U(5))], "request_id string, provider_identifier string, instrument_id string")
    out = nz.normalize_series(pages, refs, sessions(spark))
    assert [r["raw_batch_id"] for r in out.rows.collect()] == ["a"]
    assert [(r["raw_batch_id"], r["code"]) for r in out.issues.collect()] == [("a", "provider_response_error")]  # BB is absent, CC wasn't asked for
    assert sorted((r["raw_batch_id"], r["reason"]) for r in out.batch_errors.collect()) == [("b", "chunk_fingerprint"), ("c", "chunk_references"), ("d", "chunk_manifest"), ("e", "chunk_manifest")]


def test_requests_bind_pages(spark):
    pages = spark.createDataFrame([("a", "r", "s", {"k": "1"}), ("b", "r", "s", {"k": "2"}), ("c", "r", "t", {"k": "1"}), ("d", "x", "s", {}), ("e", "r", "s", None)], "raw_batch_id string, request_id string, source_id string, request_metadata map<string,string>")
    requests = spark.createDataFrame([("r", "s", {"k": "1"}, "5m")], "request_id string, source_id string, expected_metadata map<string,string>, timeframe string")
    good, errors = nz.bound_pages(pages, requests)
    assert [(r["raw_batch_id"], r["timeframe"]) for r in good.collect()] == [("a", "5m")]
    assert sorted((r["raw_batch_id"], r["reason"]) for r in errors.collect()) == [("b", "request_metadata"), ("c", "source"), ("d", "request"), ("e", "request_metadata")]


@pytest.mark.parametrize(("text", "want"), [('{"version":1,"references":[{"provider_identifier":"A"},{"provider_identifier":"B"}]}', ["A", "B"]), ('{"version":2,"references":[{"provider_identifier":"A"}]}', None), ('{"version":1,"references":[]}', None), ('{"version":1,"references":[{"provider_identifier":"A"},{"provider_identifier":"A"}]}', None), ("x", None)])
def test_chunk_manifests(spark, text, want):
    assert spark.createDataFrame([(text,)], "m string").select(nz.chunk_identifiers(F.col("m"))).first()[0] == want


def test_actions_by_endpoint(spark):
    page = lambda b, endpoint, results: (b, endpoint, bytearray(json.dumps({"status": "OK", "results": results}).encode()), "r", "A", "i", "s", date(2025, 1, 1), date(2026, 1, 1))
    change = lambda d, t: {"date": d, "type": "ticker_change", "ticker_change": {"ticker": t}}
    rows = [
        page("b1", "splits", [{"id": "1", "ticker": "A", "execution_date": "2025-07-02", "adjustment_type": "forward_split", "split_from": 1, "split_to": 4}]),
        page("b2", "dividends", [{"id": "2", "ticker": "A", "ex_dividend_date": "2025-07-02", "cash_amount": 0.123456, "currency": "usd"}]),
        page("b3", "ticker_events", {"name": "n", "events": [change("2024-01-01", "OLD"), change("2025-07-02", "A")]}),
        page("b4", "ticker_events", {"name": "n", "events": [change("2025-07-02", "B")]}),
        page("b5", "news", []),
    ]
    pages = spark.createDataFrame(rows, "raw_batch_id string, endpoint string, payload binary, request_id string, provider_identifier string, instrument_id string, source_id string, start_date date, end_date date")
    out = nz.normalize_by_endpoint(pages)
    got = {r["action_type"]: r for r in out.rows.collect()}
    assert set(got) == {"split", "dividend", "ticker_change"} and str(got["dividend"]["amount"]) == "0.123456000000000000" and got["ticker_change"]["old_ticker"] == "OLD"
    assert sorted((r["raw_batch_id"], r["reason"]) for r in out.batch_errors.collect()) == [("b4", "anchor"), ("b5", "endpoint")]
    assert [r["code"] for r in out.issues.collect()] == ["provider_definition"]


def test_actions_come_from_the_sources_of_their_endpoint(spark):
    body = bytearray(json.dumps({"status": "OK", "results": [{"id": "1", "ticker": "A", "execution_date": "2025-07-02", "adjustment_type": "forward_split", "split_from": 1, "split_to": 4}]}).encode())
    rows = [(b, e, body, "r", "A", "i", s, date(2025, 1, 1), date(2026, 1, 1)) for b, e, s in (("a", "splits", "s1"), ("b", "splits", "s2"), ("c", "splits", "d1"), ("d", "splits", None), ("e", None, "s1"), ("f", "news", "n1"))]
    pages = spark.createDataFrame(rows, "raw_batch_id string, endpoint string, payload binary, request_id string, provider_identifier string, instrument_id string, source_id string, start_date date, end_date date")
    sources = spark.createDataFrame([("splits", "s1"), ("splits", "s2"), ("dividends", "d1"), ("news", "n1")], "endpoint string, source_id string")
    out = nz.normalize_by_endpoint(pages, sources)
    assert sorted(r["raw_batch_id"] for r in out.rows.collect()) == ["a", "b"]
    assert sorted((r["raw_batch_id"], r["reason"]) for r in out.batch_errors.collect()) == [("c", "source"), ("d", "source"), ("e", "endpoint"), ("f", "endpoint")]
    assert nz.normalize_by_endpoint(pages.limit(0), sources).rows.isEmpty()


def test_a_source_is_listed_in_one_way(spark):
    from tidemark.operators.reference_data import source_dimension

    listing = lambda *rows: spark.createDataFrame(rows, "name string, provider string, dataset string, endpoint string")
    space = str(uuid.NAMESPACE_URL)
    got = source_dimension(listing(("x:bars", "x", "bars", "/v1"), ("x:bars", "x", "bars", "/v1"), ("x:acts", "x", "acts", "/v2")), space).collect()
    assert {(r["source_id"], r["name"], r["dataset"], r["endpoint"]) for r in got} == {(str(uuid.uuid5(uuid.NAMESPACE_URL, f"x:{d}")), f"x:{d}", d, e) for d, e in (("bars", "/v1"), ("acts", "/v2"))}
    for rows, why in (((("n", "x", "d", "/v1"), ("n", "x", "d", "/v2")), "several ways"), ((("n", " ", "d", "/v1"),), "needs a name"), (((None, "x", "d", "/v1"),), "needs a name")):
        with pytest.raises(Exception, match=why):
            source_dimension(listing(*rows), space).collect()


def test_name_uuids_and_slugs(spark):
    names = ["a", "é x", ""]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(name_uuid(str(uuid.NAMESPACE_DNS), F.col("n"))).collect()]
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names]
    slugs = [r[0] for r in spark.createDataFrame([("Nul",), (" É/é ",), ("_x_",), ("Šx",), ("ﬁn™ 中",)], "n string").select(slug(F.col("n"))).collect()]
    assert slugs == ["_nul", "e-e", "x", "sx", "fintm"]
    with pytest.raises(Exception, match="no safe folder name"):
        spark.createDataFrame([("..",)], "n string").select(slug(F.col("n"))).collect()


@pytest.mark.parametrize(
    ("key", "value", "request_id", "rules"),
    [
        ("next_url", "x", "r-1", ["sensitive_key"]), ("signing_key", "x", "r-1", ["sensitive_key"]), ("request_header", "x", "r-1", ["sensitive_key"]), ("X-Api-Key", "x", None, ["sensitive_key"]),
        ("note", "password: hunter2", "r-1", ["sensitive_value"]), ("note", "see Bearer abc", "r-1", ["sensitive_value"]), ("session", "regular", "r-1", []), ("page", "1", "https://x", ["request_id"]), ("page", "1", "a?b", ["request_id"]),
    ],
)
def test_metadata_safety(spark, key, value, request_id, rules):
    df = spark.createDataFrame([({key: value}, "/v2/bars", "json.gz", request_id)], "m map<string,string>, e string, x string, r string")
    assert df.select(raw.unsafe_metadata(F.col("m"), F.col("e"), F.col("x"), F.col("r"))).first()[0] == rules


def test_a_batch_of_another_request_id_or_extension_collides(spark):
    from datetime import datetime

    schema = "batch_id string, provider string, dataset string, endpoint string, retrieved_at timestamp, media_type string, request_metadata map<string,string>, payload binary, file_extension string, provider_request_id string"
    row = lambda ext, rid: ("b", "p", "d", "/e", datetime(2025, 1, 2), "application/json", {}, bytearray(b"{}"), ext, rid)
    landed = raw.manifest(spark.createDataFrame([row("json", "r1")], schema))
    for ext, rid, want in (("json", "r1", "replay"), ("json", "r2", "collision"), ("csv", "r1", "collision")):
        assert raw.classify_landing(spark.createDataFrame([row(ext, rid)], schema), landed).first()["landing"] == want


def test_actions_without_ids_with_many_digits(spark):
    v = F.parse_json(F.lit('{"cash_amount": 0.123456789012345678, "long": 0.1234567890123456789, "v": "abc", "n": null, "s": "12.5"}'))
    got = spark.range(1).select(normalize.exact(v, "$.cash_amount").cast("string").alias("a"), normalize.exact(v, "$.long").alias("b"), *(normalize.unparsable(v, f"$.{k}").alias(k) for k in ("v", "n", "s", "none"))).first()
    assert tuple(got) == ("0.123456789012345678", None, True, False, False, False)
