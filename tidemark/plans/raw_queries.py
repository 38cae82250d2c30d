"""Queries over raw pages, responses and the bar store."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidemark.functions.text import joined, name_uuid, slug
from tidemark.operators.canonical import coerce
from tidemark.plans import adapters
from tidemark.plans.adapters import table
from tidemark.sources import normalize, raw, store
from tidemark.sources.files import scratch_folder


def _batches(spark, sf_dir):
    """A raw batch an event: its properties are the payload."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k, F.concat(F.lit("b"), (k - k % 10 / 10).cast("long").cast("string")).alias("batch_id"), F.concat(F.lit("Provider "), F.upper("event_type")).alias("provider"), F.when(k % 3 == 0, "bars.5m").otherwise("Café Aux").alias("dataset"),
        F.concat(F.lit("/v2/"), F.col("event_type"), F.when(k % 17 == 0, "?x=1").otherwise("")).alias("endpoint"), F.col("ts").cast("timestamp").alias("retrieved_at"), F.lit("application/json").alias("media_type"),
        F.when(k % 29 == 0, "JSON/..").when(k % 2 == 0, "json.gz").otherwise("json").alias("extension"),
        F.create_map(
            F.lit("page_number"), (k % 7).cast("string"), F.lit("response_status"), F.when(k % 13 == 0, "429").otherwise("200"), F.when(k % 19 == 0, "X-Api-Key").otherwise("latency_ms"),
            F.when(k % 23 == 0, "NaN").when(k % 11 == 0, "12d").otherwise(F.round(F.col("value") * 4).cast("int").cast("string")), F.lit("note"), F.when(k % 31 == 0, "https://x/y").when(k % 37 == 0, "password: hunter2").otherwise("none"), F.lit("session"), F.lit("regular"),
            F.lit("rate_limit_remaining"), (k % 97).cast("string"), F.lit("rate_limit_capacity"), F.when(k % 5 == 0, "-1").otherwise((k % 5 * 100).cast("string")),
        ).alias("request_metadata"),
        F.encode("props", "UTF-8").alias("payload"),
    )


def raw_manifest(spark, sf_dir):
    x = raw.manifest(_batches(spark, sf_dir))
    return x.select("event_id", "folder", "size_bytes", "sha256", F.get_json_object("manifest", "$.schema_version").alias("version"), F.get_json_object("manifest", "$.request_metadata.page_number").alias("page"), F.get_json_object("manifest", "$.sha256").alias("listed"))


def raw_integrity(spark, sf_dir):
    """Batches whose payload was changed, cut or moved after landing."""
    k = F.col("event_id")
    b = _batches(spark, sf_dir).withColumn("batch_id", F.concat(F.lit("e"), k.cast("string")))
    spoiled = raw.manifest(b).withColumns({"payload": F.when(k % 41 == 0, F.encode(F.translate(F.decode("payload", "UTF-8"), "k", "j"), "UTF-8")).when(k % 43 == 0, F.encode(F.lit("{}"), "UTF-8")).otherwise(F.col("payload")), "batch_id": F.when(k % 47 == 0, F.lit("other")).otherwise(F.col("batch_id"))})
    return raw.integrity_errors(spoiled.withColumn("batch_id", F.col("batch_id"))).groupBy("reason").agg(F.count(F.lit(1)).alias("batches"))


def raw_collisions(spark, sf_dir):
    """All events landed, and all of them come again: some as they were, some with another payload, some as new batches, some of those twice or with others of their id."""
    b, k = _batches(spark, sf_dir), F.col("event_id")
    old = raw.manifest(b.withColumn("batch_id", F.concat(F.lit("b"), k.cast("string"))))
    kind = k % 5
    number = F.when(kind == 2, k + 1_000_000_000).when(kind == 3, F.floor(k / 10) + 2_000_000_000).when(kind == 4, k + 3_000_000_000).otherwise(k)
    payload = F.when(kind == 1, F.encode(F.lit("{}"), "UTF-8")).otherwise(F.col("payload"))
    again = b.withColumns({"payload": payload, "batch_id": F.concat(F.lit("b"), number.cast("string")), "times": F.explode(F.sequence(F.lit(1), F.when(kind == 4, 2).otherwise(1)))}).drop("times")
    return raw.classify_landing(again, old)


def metadata_violations(spark, sf_dir):
    k = F.col("event_id")
    said = F.when(k % 41 == 0, "r?x").when(k % 43 == 0, F.concat(F.lit("https://ids/"), k.cast("string"))).otherwise(F.concat(F.lit("r-"), k.cast("string")))
    x = _batches(spark, sf_dir).withColumn("rules", raw.unsafe_metadata(F.col("request_metadata"), F.col("endpoint"), F.col("extension"), said))
    return x.select("event_id", joined(F.col("rules")).alias("rules")).filter("rules <> ''")


def partition_slugs(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_partkey"), F.when(F.col("p_partkey") % 50 == 0, F.lit("CON")).when(F.col("p_partkey") % 50 == 2, F.lit("_Šx ﬁn™_")).when(F.col("p_partkey") % 50 == 3, F.concat(F.lit("\U0001d400bc \U0001f130"), F.col("p_partkey").cast("string"))).when(F.col("p_partkey") % 50 == 1, F.concat(F.lit(" Ünïted/"), F.col("p_name"), F.lit(" "))).otherwise(F.col("p_brand")).alias("name"))
    return names.select("p_partkey", slug(F.col("name")).alias("slug"))


def response_outcomes(spark, sf_dir):
    """Outcomes, by both sets of rules, of responses whose statuses and bodies follow from the events."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 18
    status = F.when(k == 1, 401).when(k == 2, 403).when(k.isin(3, 4, 17), 422).when(k == 5, 429).when(k == 6, 500).otherwise(200)
    bodies = {3: '{"code": 42210000, "message": "x"}', 7: '{"status": "error", "code": 401}', 8: '{"status": "error", "code": 429}', 9: "[1]", 10: '{"status": "error", "code": 403}', 11: '{"status": "partial"}', 12: '{"status": "error", "code": "401"}', 13: '{"status": "error", "code": 401.7}', 14: '{"status": "ERROR", "code": 401}', 15: '{"status": "ok"}', 16: '{"status": "error", "code": 99}', 17: '{"code": "42210000"}'}
    body = F.col("props")
    for n, text in bodies.items():
        body = F.when(k == n, text).otherwise(body)
    v = raw.parsed(F.encode(body, "UTF-8"))
    x = e.withColumns({"outcome": raw.outcome(status, v), "http_outcome": raw.outcome(status, v, "http"), "kind": k})
    return x.groupBy("kind", "outcome", "http_outcome").agg(F.count(F.lit(1)).alias("responses"))


def preflight_outcomes(spark, sf_dir):
    """Probe responses whose statuses and bodies follow from the events: what they amount to, and the observations of authorized ones."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id") % 12
    status = F.when(k == 6, 401).when(k == 7, 403).when(k.isin(8, 9), 422).when(k == 10, 429).when(k == 11, 201).otherwise(200)
    some = F.array_join(F.transform(F.sequence(F.lit(1), F.col("user_id") % 3 + 1), lambda i: i.cast("string")), ",")
    good = F.concat(F.lit('{"bars": {"S": ['), some, F.lit("]}}"))
    body = F.when(k == 1, '{"bars": {"T": [1]}}').when(k == 2, '{"bars": {"S": 1}}').when(k == 3, '{"bars": [1]}').when(k == 4, "nothing").when(k == 5, '{"bars": {}}').when(k == 8, '{"code": 42210000}').when(k == 9, '{"code": "42210000"}').otherwise(good)
    x = raw.preflight(e.select(k.alias("kind"), status.alias("status"), raw.parsed(F.encode(body, "UTF-8")).alias("body"), F.lit("S").alias("identifier")))
    return x.groupBy("kind", F.col("preflight").alias("outcome")).agg(F.count(F.lit(1)).alias("responses"), F.sum("observations").alias("observations"))


def enriched_responses(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    headers = F.create_map(F.when(k % 3 == 0, "X-RateLimit-Remaining").when(k % 3 == 1, "api-credits-left").otherwise("x-rate-limit-remaining"), F.when(k % 5 == 0, "-1").when(k % 5 == 1, "inf").otherwise((k % 100).cast("string")), F.when(k % 2 == 0, "X-Request-Id").otherwise("apca-request-id"), F.when(k % 7 == 0, "http://id").otherwise(F.concat(F.lit("r-"), k.cast("string"))), F.lit("Retry-After"), F.when(k % 4 == 0, "soon").otherwise((k % 60).cast("string")))
    body = F.concat(F.lit('{"request_id": '), F.when(k % 21 == 0, F.concat(F.lit('"b'), k.cast("string"), F.lit('"'))).when(k % 14 == 0, k.cast("string")).otherwise("true"), F.lit("}"))
    x = raw.enriched(e.select(k, headers.alias("headers"), F.encode(body, "UTF-8").alias("body"), (F.col("value") / 1000).alias("elapsed_s")))
    return x.select("event_id", F.col("retry_after_s").cast("long").alias("retry_after"), F.col("rate_limit_remaining").cast("long").alias("remaining"), "request_id", F.round("latency_ms", 2).alias("latency_ms"))


def page_chain_audit(spark, sf_dir):
    """Every user's events are pages of one request; each says which page comes next, some in ways that it may not."""
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    n = F.row_number().over(W.partitionBy("user_id").orderBy("event_id"))
    url = F.concat(
        F.lit("https://"), F.when(k % 223 == 0, "other").otherwise("h"), F.lit("/v2/"), F.when(k % 301 == 0, "other").otherwise("bars"), F.lit("?Cursor=t"), F.when(k % 701 == 0, 0).otherwise(k).cast("string"),
        F.when(k % 227 == 0, "&api%5Fkey=x").otherwise(""), F.when(k % 229 == 0, "&limit=5").otherwise(""),
    )
    body = F.when(k % 211 == 0, '{"next_url": 5}').when(k % 233 == 0, "[]").when(k % 239 == 0, '{"next_url": null, "next_page_token": ""}').otherwise(F.to_json(F.struct(url.alias("next_url"))))
    pages = e.select(F.col("user_id").alias("request_id"), k, n.alias("n"), F.encode(body, "UTF-8").alias("payload"))
    pages = pages.select("request_id", F.when(k % 501 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("page_number"), "payload", F.lit("h").alias("host"), F.lit("/v2/bars").alias("endpoint"))
    return raw.page_chain_audit(pages, 70)


def runtime_summary(spark, sf_dir):
    return raw.runtime_summary(_batches(spark, sf_dir)).select("provider", "batches", "datasets", "statuses", "latencies", F.col("latency_sum").cast("long").alias("latency_sum"), F.col("latency_max").cast("long").alias("latency_max"), F.col("remaining_min").cast("long").alias("remaining_min"), "capacities")


NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


def source_identities(spark, sf_dir):
    """Stable ids of sources from their names."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", name_uuid(NAMESPACE, F.col("s_name")).alias("source_id"))


def bound_pages(spark, sf_dir):
    """Pages bound to requests: an event's request is its user, a request's source its user's last digit, and it expects a page number."""
    b = _batches(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    k = F.col("event_id")
    pages = b.select(k.cast("string").alias("raw_batch_id"), F.col("user_id").alias("request_id"), F.when(k % 37 == 0, "s-other").otherwise(F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string"))).alias("source_id"), "request_metadata")
    requests = table(spark, sf_dir, "events").select("user_id").distinct().filter("user_id % 50 <> 0")
    requests = requests.select(F.col("user_id").alias("request_id"), F.concat(F.lit("s"), (F.col("user_id") % 10).cast("string")).alias("source_id"), F.when(F.col("user_id") % 3 == 0, F.create_map(F.lit("response_status"), F.lit("200"))).alias("expected_metadata"), F.lit("5m").alias("timeframe"))
    good, errors = normalize.bound_pages(pages, requests)
    return good.select("raw_batch_id", F.lit("ok").alias("reason")).unionByName(errors).groupBy("reason").agg(F.count(F.lit(1)).alias("pages"))


QUERY = store.BarQuery(timeframe="5m", session="regular", adjustment_state="unadjusted", start=datetime(1996, 2, 1, tzinfo=UTC), end=datetime(1998, 9, 1, tzinfo=UTC))


def bar_query(spark, sf_dir):
    x = store.ordered(store.apply_query(adapters.bars(spark, sf_dir), QUERY))
    return x.select(F.unix_micros("timestamp_start").alias("start_us"), "instrument_id", "source_id", "open", "volume", joined(F.array_sort("quality_flags")).alias("flags"))


def partition_keys(spark, sf_dir):
    return store.partition_keys(adapters.bars(spark, sf_dir))


def store_roundtrip(spark, sf_dir):
    """Bars written to the store, scanned back through partition pruning, counted by partition."""
    root = scratch_folder(spark, "store")
    bars = adapters.bars(spark, sf_dir)
    store.BarStore(spark, root).append(bars)
    back = store.BarStore(spark, root).query(QUERY)
    return back.groupBy("timeframe", F.year("timestamp_start").alias("year"), F.month("timestamp_start").alias("month")).agg(F.count(F.lit(1)).alias("bars"), F.count_distinct("instrument_id").alias("instruments"), F.max("high").alias("high"))


def coerced_bars(spark, sf_dir):
    """Coercion of upper-case, braced ids and padded flags."""
    b = adapters.bars(spark, sf_dir).withColumns({"instrument_id": F.concat(F.lit("{"), F.upper("instrument_id"), F.lit("}")), "source_id": F.concat(F.lit("urn:uuid:"), F.col("source_id")), "raw_batch_id": F.regexp_replace("raw_batch_id", "-", ""), "quality_flags": F.array_union("quality_flags", F.array(F.lit(" a_flag\t")))})
    x = coerce(b)
    return x.select("instrument_id", "source_id", "raw_batch_id", F.unix_micros("timestamp_start").alias("start_us"), joined(F.col("quality_flags")).alias("flags"))


_SLUG = "trim(regexp_replace(strip_accents({c}), '[^A-Za-z0-9_-]+', '-', 'g'), '-_')"
_DATASET = "CASE WHEN event_id % 3 = 0 THEN 'bars-5m' ELSE 'cafe-aux' END"
_W = "timeframe = '5m' AND session = 'regular' AND adjustment_state = 'unadjusted' AND timestamp_start >= TIMESTAMP '1996-02-01' AND timestamp_start < TIMESTAMP '1998-09-01'"
_LEFT = adapters.bars_sql("left")
_CASE_LAT = "CASE WHEN event_id % 23 = 0 OR event_id % 11 = 0 OR event_id % 19 = 0 THEN NULL ELSE CAST(round(value * 4) AS INTEGER) END"
QUERIES = {
    "raw_manifest": (raw_manifest, f"SELECT event_id, 'provider=provider-' || event_type || '/dataset=' || {_DATASET} || '/retrieval_date=' || strftime(ts, '%Y-%m-%d') AS folder, strlen(props)::BIGINT AS size_bytes, sha256(props) AS sha256, '1' AS version, (event_id % 7)::VARCHAR AS page, sha256(props) AS listed FROM events"),
    "raw_integrity": (
        raw_integrity,
        """WITH r AS (SELECT CASE WHEN event_id % 47 = 0 THEN 'manifest' WHEN event_id % 41 = 0 THEN 'sha256' WHEN event_id % 43 = 0 THEN 'size' END AS reason FROM events) SELECT reason, count(*) AS batches FROM r WHERE reason IS NOT NULL GROUP BY 1""",
    ),
    "raw_collisions": (
        raw_collisions,
        """SELECT 'b' || event_id AS batch_id, CASE event_id % 5 WHEN 0 THEN 'replay' ELSE 'collision' END AS landing FROM events WHERE event_id % 5 < 2
UNION ALL SELECT 'b' || (event_id + CASE event_id % 5 WHEN 2 THEN 1000000000 ELSE 3000000000 END), 'new' FROM events WHERE event_id % 5 IN (2, 4)
UNION ALL SELECT 'b' || (event_id // 10 + 2000000000), CASE WHEN count(*) > 1 THEN 'collision' ELSE 'new' END FROM events WHERE event_id % 5 = 3 GROUP BY 1""",
    ),
    "metadata_violations": (
        metadata_violations,
        """WITH r AS (SELECT event_id, array_to_string([x FOR x IN [CASE WHEN event_id % 19 = 0 THEN 'sensitive_key' END, CASE WHEN event_id % 31 = 0 OR event_id % 37 = 0 THEN 'sensitive_value' END, CASE WHEN event_id % 17 = 0 THEN 'endpoint' END, CASE WHEN event_id % 29 = 0 THEN 'extension' END, CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'request_id' END] IF x IS NOT NULL], ',') AS rules FROM events) SELECT * FROM r WHERE rules <> ''""",
    ),
    "partition_slugs": (partition_slugs, f"SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN '_con' WHEN p_partkey % 50 = 2 THEN 'sx-fintm' WHEN p_partkey % 50 = 3 THEN 'abc-a' || p_partkey WHEN p_partkey % 50 = 1 THEN lower({_SLUG.format(c=chr(39) + ' Ünïted/' + chr(39) + ' || p_name')}) ELSE lower({_SLUG.format(c='p_brand')}) END AS slug FROM part"),
    "response_outcomes": (
        response_outcomes,
        """SELECT event_id % 18 AS kind,
  CASE event_id % 18 WHEN 1 THEN 'authentication' WHEN 2 THEN 'entitlement' WHEN 3 THEN 'http_error' WHEN 4 THEN 'http_error' WHEN 5 THEN 'rate_limit' WHEN 6 THEN 'http_error' WHEN 7 THEN 'authentication' WHEN 8 THEN 'rate_limit' WHEN 10 THEN 'entitlement'
    WHEN 9 THEN 'malformed_response' WHEN 11 THEN 'malformed_response' WHEN 12 THEN 'malformed_response' WHEN 13 THEN 'malformed_response' WHEN 14 THEN 'malformed_response' WHEN 16 THEN 'malformed_response' WHEN 17 THEN 'http_error' ELSE 'ok' END AS outcome,
  CASE event_id % 18 WHEN 1 THEN 'authentication' WHEN 2 THEN 'access' WHEN 3 THEN 'entitlement' WHEN 4 THEN 'http_error' WHEN 5 THEN 'rate_limit' WHEN 6 THEN 'http_error' WHEN 17 THEN 'http_error' ELSE 'ok' END AS http_outcome, count(*) AS responses FROM events GROUP BY 1, 2, 3""",
    ),
    "preflight_outcomes": (
        preflight_outcomes,
        """SELECT event_id % 12 AS kind, CASE event_id % 12 WHEN 0 THEN 'authorized' WHEN 5 THEN 'authorized' WHEN 6 THEN 'authentication_failed' WHEN 7 THEN 'authentication_or_permission_denied' WHEN 8 THEN 'entitlement_denied' WHEN 9 THEN 'http_error' WHEN 10 THEN 'rate_limited' WHEN 11 THEN 'http_error' ELSE 'malformed_response' END AS outcome,
  count(*) AS responses, (sum(CASE event_id % 12 WHEN 0 THEN user_id % 3 + 1 WHEN 5 THEN 0 END))::BIGINT AS observations FROM events GROUP BY 1, 2""",
    ),
    "enriched_responses": (enriched_responses, "SELECT event_id, CASE WHEN event_id % 4 > 0 THEN event_id % 60 END AS retry_after, CASE WHEN event_id % 5 > 1 THEN event_id % 100 END AS remaining, CASE WHEN event_id % 7 <> 0 THEN 'r-' || event_id WHEN event_id % 21 = 0 THEN 'b' || event_id WHEN event_id % 14 = 0 THEN event_id::VARCHAR END AS request_id, round(value, 2) AS latency_ms FROM events"),
    "page_chain_audit": (
        page_chain_audit,
        """WITH p AS (SELECT user_id AS r, event_id AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
q AS (SELECT r, CASE WHEN k % 501 = 0 THEN n + 1 ELSE n END AS n, k % 211 = 0 AS odd, k % 211 <> 0 AND k % 233 = 0 AS bad, k % 211 <> 0 AND k % 233 <> 0 AND k % 239 <> 0 AS linked, k % 223 = 0 AS h, k % 301 = 0 AS e, k % 227 = 0 AS c, k % 229 = 0 AS x, CASE WHEN k % 701 = 0 THEN 0 ELSE k END AS t FROM p),
w AS (SELECT *, CASE WHEN linked THEN count(*) FILTER (linked) OVER (PARTITION BY r, t, h, e, c, x) END AS same, n - lag(n) OVER (PARTITION BY r ORDER BY n) AS g FROM q)
SELECT DISTINCT r AS request_id, 'token_type' AS problem FROM q WHERE odd UNION ALL SELECT DISTINCT r, 'invalid_json' FROM q WHERE bad
UNION ALL SELECT DISTINCT r, CASE WHEN h THEN 'host_drift' WHEN e THEN 'endpoint_drift' WHEN c THEN 'credential_key' ELSE 'extra_query' END FROM q WHERE linked AND (h OR e OR c OR x)
UNION ALL SELECT DISTINCT r, 'repeated_token' FROM w WHERE same > 1 UNION ALL SELECT DISTINCT r, 'page_gap' FROM w WHERE g <> 1 UNION ALL SELECT r, 'too_many_pages' FROM q GROUP BY r HAVING max(n) > 70""",
    ),
    "runtime_summary": (
        runtime_summary,
        f"""SELECT 'Provider ' || upper(event_type) AS provider, count(*) AS batches, 'Café Aux,bars.5m' AS datasets, '200,429' AS statuses, count({_CASE_LAT}) AS latencies, sum({_CASE_LAT})::BIGINT AS latency_sum, max({_CASE_LAT})::BIGINT AS latency_max, min(event_id % 97) AS remaining_min, '100,200,300,400' AS capacities FROM events GROUP BY event_type""",
    ),
    "source_identities": (
        source_identities,
        """WITH h AS (SELECT s_suppkey, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(s_name)) AS d FROM supplier)
SELECT s_suppkey, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(d, 18, 3) || '-' || substr(d, 21, 12) AS source_id FROM h""",
    ),
    "bound_pages": (
        bound_pages,
        "SELECT CASE WHEN user_id % 50 = 0 THEN 'request' WHEN event_id % 37 = 0 THEN 'source' WHEN user_id % 3 = 0 AND event_id % 13 = 0 THEN 'request_metadata' ELSE 'ok' END AS reason, count(*) AS pages FROM events GROUP BY 1",
    ),
    "bar_query": (bar_query, f"SELECT epoch_us(timestamp_start) AS start_us, instrument_id, source_id, open, volume, array_to_string(list_sort(quality_flags), ',') AS flags FROM ({_LEFT}) WHERE {_W}"),
    "partition_keys": (partition_keys, f"SELECT DISTINCT timeframe, year(timestamp_start)::INTEGER AS year, month(timestamp_start)::INTEGER AS month FROM ({_LEFT})"),
    "store_roundtrip": (store_roundtrip, f"SELECT timeframe, year(timestamp_start)::INTEGER AS year, month(timestamp_start)::INTEGER AS month, count(*) AS bars, count(DISTINCT instrument_id) AS instruments, max(high) AS high FROM ({_LEFT}) WHERE {_W} GROUP BY 1, 2, 3"),
    "coerced_bars": (coerced_bars, f"SELECT instrument_id, source_id, raw_batch_id, epoch_us(timestamp_start) AS start_us, array_to_string(list_sort(list_concat(quality_flags, ['a_flag'])), ',') AS flags FROM ({_LEFT})"),
}
