"""Decimals, slugs, response outcomes and page chains on the cases that a sample of clean data doesn't hold."""

import json
import unicodedata
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.sources import normalize, raw


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("1e-20", None), ("1E-19", None), ("1e-18", "1E-18"), ("0e-30", "0"), ("1.5e3", "1500"), ('"1e-20"', None), ('"0.1234567890123456789"', None), ("0.123456789012345678", "0.123456789012345678"),
        ("12345678901234567890.5", "12345678901234567890.5"), ("123456789012345678901", None), ('"-2.50"', "-2.5"), ("1e20", None), ('"abc"', None), ("null", None), ("true", None), ("0.10000000000000000000000", "0.1"), ('" 7 "', "7"), ("[1]", None),
    ],
)
def test_decimals_are_exact_or_rejected(spark, value, want):
    got = spark.range(1).select(normalize.exact(F.parse_json(F.lit(f'{{"x": {value}}}')), "$.x")).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_ratios_to_the_last_digit(spark):
    pairs = [("4", "1"), ("1", "3"), ("2", "3"), ("1.234567890123", "1"), ("2", "0.7"), ("0.000000000001", "3"), ("99999999999999999", "7"), ("123456.123456", "0.000001"), ("1", "0"), ("-1", "2"), ("1.00000000000000001", "3"), ("0.5", "1.25")]
    rows = spark.createDataFrame([(i, Decimal(a), Decimal(b)) for i, (a, b) in enumerate(pairs)], "i int, a decimal(38,18), b decimal(38,18)")
    got = {r["i"]: r["r"] for r in rows.select("i", normalize.ratio(F.col("a"), F.col("b")).alias("r")).collect()}
    with localcontext(prec=60):
        for i, (a, b) in enumerate(pairs):
            fits = Decimal(a) > 0 and Decimal(b) > 0 and a != "1.00000000000000001"  # 18 digits
            assert got[i] == ((Decimal(a) / Decimal(b)).quantize(Decimal(1).scaleb(-20), "ROUND_HALF_UP") if fits else None), pairs[i]


def test_every_code_point_folds_as_compatibility_decomposition_says(spark):
    texts = [chr(n) for n in (*range(1, 0xD800), *range(0xE000, 0x110000)) if n < 0x3000 or unicodedata.decomposition(chr(n)) or n % 97 == 0]
    rows = spark.createDataFrame([("".join(f"a{c}b|" for c in texts[k : k + 20]),) for k in range(0, len(texts), 20)], "t string")
    for r in rows.select("t", folded(F.col("t")).alias("f")).collect():
        assert r["f"] == unicodedata.normalize("NFKD", r["t"]).encode("ascii", "ignore").decode()


CASES = [
    (200, '{"status":"error","code":"401"}', "malformed_response", "ok"), (200, '{"status":"error","code":401.7}', "malformed_response", "ok"), (200, '{"status":"ERROR","code":401}', "malformed_response", "ok"), (200, '{"status":"error","code":401}', "authentication", "ok"),
    (200, '{"status":"error","code":404}', "http_error", "ok"), (200, '{"status":"ok"}', "ok", "ok"), (200, "{}", "ok", "ok"), (200, "[1]", "malformed_response", "ok"), (200, '{"status":null}', "ok", "ok"), (200, '{"status":1}', "malformed_response", "ok"),
    (403, "{}", "entitlement", "access"), (401, "", "authentication", "authentication"), (422, '{"code":42210000}', "http_error", "entitlement"), (422, '{"code":"42210000"}', "http_error", "http_error"), (204, "", "malformed_response", "ok"), (500, '{"status":"ok"}', "http_error", "http_error"),
    (200, '{"status":"error","code":true}', "malformed_response", "ok"), (200, '{"status":"error","code":99}', "malformed_response", "ok"), (429, "x", "rate_limit", "rate_limit"),
]


def test_outcomes_by_both_sets_of_rules(spark):
    rows = spark.createDataFrame([(i, s, bytearray(b.encode())) for i, (s, b, *_) in enumerate(CASES)], "i int, s int, b binary").withColumn("v", raw.parsed(F.col("b")))
    got = rows.select("i", raw.outcome(F.col("s"), F.col("v")).alias("a"), raw.outcome(F.col("s"), F.col("v"), "http").alias("b")).orderBy("i").collect()
    assert [(r["a"], r["b"]) for r in got] == [c[2:] for c in CASES]
    with pytest.raises(ValueError, match="rules"):
        raw.outcome(F.col("s"), F.col("v"), "other")


def test_preflight(spark):
    cases = [(200, '{"bars":{"S":[1,2]}}', "authorized", 2), (200, '{"bars":{}}', "authorized", 0), (200, '{"bars":{"T":[1]}}', "malformed_response", None), (200, '{"bars":{"S":{}}}', "malformed_response", None), (200, '{"bars":[]}', "malformed_response", None), (200, "{", "malformed_response", None), (201, '{"bars":{}}', "http_error", None), (401, "", "authentication_failed", None), (403, "", "authentication_or_permission_denied", None), (422, '{"code":42210000}', "entitlement_denied", None), (422, "", "http_error", None), (429, "", "rate_limited", None)]
    rows = spark.createDataFrame([(i, s, bytearray(b.encode()), "S") for i, (s, b, *_) in enumerate(cases)], "i int, status int, b binary, identifier string").withColumn("body", raw.parsed(F.col("b")))
    assert [(r["preflight"], r["observations"]) for r in raw.preflight(rows).orderBy("i").collect()] == [c[2:] for c in cases]


LINKS = [
    ("https://h/p?cursor=1", None), ("https://h/p?CURSOR=1", None), ("http://h/p?cursor=1", "host_drift"), ("https://h:8/p?cursor=1", "host_drift"), ("https://u@h/p?cursor=1", "host_drift"), ("https://h/p?cursor=1#f", "host_drift"), ("https://other/p?cursor=1", "host_drift"),
    ("https://h/q?cursor=1", "endpoint_drift"), ("https://h/p?cursor=1&apiKey=x", "credential_key"), ("https://h/p?cursor=1&api%5Fkey=x", "credential_key"), ("https://h/p?cursor=1&limit=5", "extra_query"), ("https://h/p?cursor=", "extra_query"), ("https://h/p", "extra_query"), ("https://h/p?page=1", "extra_query"), ("nonsense", "host_drift"),
]


def test_links_to_the_next_page(spark):
    bodies = [({"next_url": u}, p) for u, p in LINKS] + [({"next_url": 5}, "token_type"), ({"next_url": None}, None), ({}, None), ({"next_page_token": 7}, "token_type"), ({"next_page_token": ""}, None), ({"next_page_token": "t"}, None), ([], "invalid_json")]
    rows = spark.createDataFrame([(i, bytearray(json.dumps(b).encode()), "h", "/p") for i, (b, _) in enumerate(bodies)], "i int, payload binary, host string, endpoint string")
    assert [r["problem"] for r in raw.page_links(rows).orderBy("i").collect()] == [p for _, p in bodies]


def test_chains_of_pages(spark):
    page = lambda r, n, t: (r, n, bytearray(json.dumps({"next_page_token": t}).encode()), None, None)
    rows = [page("good", 1, "a"), page("good", 2, "b"), page("good", 3, None), page("gap", 1, "a"), page("gap", 3, "b"), page("twice", 1, "a"), page("twice", 1, "b"), page("loop", 1, "a"), page("loop", 2, "a"), *(page("long", n, f"t{n}") for n in range(1, 7))]
    df = spark.createDataFrame(rows, "request_id string, page_number int, payload binary, host string, endpoint string")
    assert sorted(map(tuple, raw.page_chain_audit(df, 5).collect())) == [("gap", "page_gap"), ("long", "too_many_pages"), ("loop", "repeated_token"), ("twice", "page_gap")]
