"""Raw pages: landing with collision checks, manifests, integrity, metadata safety, response and page-chain audits.

A raw batch is a row: batch_id, provider, dataset, endpoint, retrieved_at, media_type, request_metadata (map), payload, and if
known source_id, license_classification, file_extension and provider_request_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import finite, iso, slug
from tidemark.sources.files import delete, names_in, scratch_folder

# What must not appear in stored request metadata, as a word of a key, anywhere in a key, and in a value.
SENSITIVE_WORDS = ("authorization", "cookie", "credential", "credentials", "header", "headers", "key", "password", "secret", "token", "uri", "url")
SENSITIVE_FRAGMENTS = ("apikey", "authorization", "cookie", "credential", "header", "password", "secret", "token", "uri", "url")
_COMPLETE_URL = r"(?i)[a-z][a-z0-9+.-]*://"
_SECRET_VALUE = r"(?i)(?:\b(?:basic|bearer)\s+|(?:authorization|api[_-]?key|access[_-]?token|token|password|secret)\s*[:=])"
_EXTENSION = r"^[A-Za-z0-9][A-Za-z0-9._-]{0,31}$"
HTTP_OUTCOMES = {401: "authentication", 403: "access", 429: "rate_limit"}


class CollisionError(ValueError):
    """A batch id is already landed with other content."""


def sealed(batches: DataFrame) -> DataFrame:
    """With the payload's checksum and size and the folder that the batch belongs in."""
    return batches.withColumns(
        {
            "sha256": F.sha2("payload", 256),
            "size_bytes": F.octet_length("payload").cast("long"),
            "folder": F.concat(F.lit("provider="), slug(F.col("provider")), F.lit("/dataset="), slug(F.col("dataset")), F.lit("/retrieval_date="), F.date_format("retrieved_at", "yyyy-MM-dd")),
        }
    )


def manifest(batches: DataFrame) -> DataFrame:
    """sealed() with the manifest: compact JSON of all that is known of the batch."""
    more = {c: F.col(c) if c in batches.columns else F.lit(None).cast("string") for c in ("file_extension", "license_classification", "provider_request_id", "source_id")}
    fields = F.struct(
        *(c.alias(n) for n, c in more.items()), F.col("batch_id"), F.col("dataset"), F.col("endpoint").alias("logical_endpoint"), F.col("media_type"), F.col("provider"),
        F.map_from_entries(F.array_sort(F.map_entries("request_metadata"))).alias("request_metadata"), iso(F.col("retrieved_at")).alias("retrieved_at"),
        F.lit(1).alias("schema_version"), F.col("sha256"), F.col("size_bytes"),
    )
    return sealed(batches).withColumn("manifest", F.to_json(fields))


def _identity() -> list[Column]:
    """What tells a batch from another of its id: a digest of 128 bits (two 64-bit hashes) of its folder and manifest."""
    said = F.to_json(F.struct("folder", "manifest"))
    return [F.xxhash64(F.lit(i), said).alias(f"_digest{i}") for i in range(2)]


def _judged(ready: DataFrame, landed: DataFrame) -> DataFrame:
    """Ids of batches that have their manifest, with `landing` and the `rows` of each. Only ids and digests are shuffled."""
    ends = [f(f"_digest{i}").alias(f"_{n}{i}") for i in range(2) for n, f in (("a", F.min), ("z", F.max))]
    own = ready.select("batch_id", *_identity()).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows"), *ends)
    old = landed.select("batch_id", *_identity(), F.lit(True).alias("_there"))
    one = (F.col("_a0") == F.col("_z0")) & (F.col("_a1") == F.col("_z1"))
    same = (F.col("_a0") == F.col("_digest0")) & (F.col("_a1") == F.col("_digest1"))
    state = F.when(~one, "collision").when(F.col("_there").isNull(), "new").when(same, "replay").otherwise("collision")
    return own.join(old, "batch_id", "left").select("batch_id", state.alias("landing"), "rows")


def classify_landing(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """incoming batches (one row an id) with `landing`: new, replay (the same in all that the manifest says), or collision.

    Incoming rows are judged against each other too: equal rows are one batch, different ones of one id collide.
    """
    return _judged(manifest(incoming), landed).drop("rows")


def land(incoming: DataFrame, root: str) -> DataFrame:
    """Append new batches under root; replays are no-ops and any collision fails the whole call. Returns id and landing, from a written table.

    incoming is computed once, into a table that is gone when the call ends: so what is judged is what is written. Payloads are shuffled only
    if some batch is no new one or comes twice. One writer at a time may land under a root: what another one lands between the comparison
    and the write isn't seen.
    """
    spark = incoming.sparkSession
    staged, path = scratch_folder(spark, "staged"), scratch_folder(spark, "landing")
    try:
        sealed_once = manifest(incoming)
        sealed_once.write.parquet(staged, compression="zstd")
        ready = spark.read.schema(sealed_once.schema).parquet(staged)
        landed = spark.read.parquet(root) if [n for n in names_in(spark, root) if n[0] not in "._"] else ready.limit(0)
        judged = _judged(ready, landed)
        judged.write.parquet(path, compression="zstd")
        found = spark.read.schema(judged.schema).parquet(path)
        bad = [r["batch_id"] for r in found.filter("landing = 'collision'").limit(5).collect()]
        if bad:
            raise CollisionError(f"batches landed with other content: {bad}")
        fresh = ready
        if not found.filter("landing <> 'new' OR rows > 1").isEmpty():
            fresh = ready.dropDuplicates(["batch_id"]).join(found.filter("landing = 'new'").select("batch_id"), "batch_id", "left_semi")
        dated = fresh.withColumns({"p_provider": slug(F.col("provider")), "p_dataset": slug(F.col("dataset")), "retrieval_date": F.date_format("retrieved_at", "yyyy-MM-dd")})
        dated.write.mode("append").partitionBy("p_provider", "p_dataset", "retrieval_date").parquet(root, compression="zstd")
    finally:
        delete(spark, staged)
    return found.drop("rows")


def landed_batches(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """The landed batches of these ids (batch_id, each once and landed). If the root holds as many, they are all of them and nothing is joined."""
    landed = spark.read.parquet(root)
    return landed if landed.count() == ids.count() else landed.join(ids, "batch_id", "left_semi")


def integrity_errors(landed: DataFrame) -> DataFrame:
    """Landed batches whose payload isn't what the manifest says, with the reason."""
    m = F.from_json("manifest", "batch_id string, sha256 string, size_bytes bigint")
    x = landed.withColumn("_m", m)
    reason = (
        F.when(F.col("_m.batch_id").isNull() | (F.col("_m.batch_id") != F.col("batch_id")), "manifest")
        .when(F.col("_m.size_bytes") != F.octet_length("payload"), "size")
        .when(F.col("_m.sha256") != F.sha2("payload", 256), "sha256")
    )
    return x.withColumn("reason", reason).filter("reason IS NOT NULL").select("batch_id", "reason")


def unsafe_metadata(metadata: Column, endpoint: Column, extension: Column, request_id: Column | None = None) -> Column:
    """Names of the safety rules that a batch's metadata, endpoint, file extension and provider's request id break."""
    entries = F.map_entries(metadata)

    def sensitive(e: Column) -> Column:
        words = F.split(F.lower(e["key"]), "[^a-z0-9]+")
        return F.arrays_overlap(words, F.lit(list(SENSITIVE_WORDS))) | F.array_join(words, "").rlike("|".join(SENSITIVE_FRAGMENTS))

    secret = lambda c: c.rlike(_COMPLETE_URL) | c.rlike(_SECRET_VALUE)
    rules = {
        "sensitive_key": F.exists(entries, sensitive),
        "sensitive_value": F.exists(entries, lambda e: F.coalesce(secret(e["value"]), F.lit(False))),
        "endpoint": endpoint.rlike(r"://|[?#]"),
        "extension": ~extension.rlike(_EXTENSION) | extension.contains(".."),
    }
    if request_id is not None:
        rules["request_id"] = secret(request_id) | request_id.rlike(r"[?#\n\r]")
    return F.array_compact(F.array(*(F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in rules.items())))


def safe_number(text: Column) -> Column:
    """A header as a number if it is one, finite and not negative. A trailing type letter doesn't make a number."""
    x = F.when(F.trim(text).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.trim(text).try_cast("double"))
    return F.when(finite(x) & (x >= 0), x)


# The headers that carry each number and the provider's request id, the first present one counts.
NUMBER_HEADERS = {
    "rate_limit_capacity": ("x-ratelimit-limit", "x-rate-limit-limit"),
    "rate_limit_remaining": ("x-ratelimit-remaining", "x-rate-limit-remaining", "api-credits-left"),
    "rate_limit_reset": ("x-ratelimit-reset", "x-rate-limit-reset"),
    "api_credits_used": ("api-credits-used",),
    "retry_after_s": ("retry-after",),
}
REQUEST_ID_HEADERS = ("x-request-id", "request-id", "apca-request-id")
_REQUEST_ID = r"^[A-Za-z0-9._:-]{1,256}$"


def enriched(responses: DataFrame) -> DataFrame:
    """Responses (headers map, elapsed seconds, and body if known) with latency in milliseconds, limits and a safe request id.

    Header names count whatever their case. The request id is the first safe one of the headers, else the body's (text or a
    whole number).
    """
    def header(name: str) -> Column:
        return F.get(F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == name), 0)["value"]

    ids = [header(n) for n in REQUEST_ID_HEADERS]
    if "body" in responses.columns:
        said = F.try_variant_get(parsed(F.col("body")), "$.request_id", "variant")
        kind = F.schema_of_variant(said)
        ids.append(F.when(kind.isin("STRING", "BIGINT"), F.try_variant_get(said, "$", "string")))
    numbers = {name: safe_number(F.coalesce(*map(header, names))) for name, names in NUMBER_HEADERS.items()}
    return responses.withColumns({"latency_ms": F.round(F.col("elapsed_s") * 1000, 3), **numbers, "request_id": F.coalesce(*(F.when(x.rlike(_REQUEST_ID), x) for x in ids))})


def parsed(payload: Column) -> Column:
    """The payload as VARIANT if it is a JSON object, else null. Numbers keep their digits."""
    text = F.decode(payload, "UTF-8")  # decoded twice, which takes less than a lambda that would have all of a step interpreted
    return F.when(text.rlike(r"^[ \t\r\n]*\{"), F.try_parse_json(text))


#: JSON kinds of whole numbers.
_WHOLE = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def _whole(v: Column, path: str) -> Column:
    """A whole JSON number at path; null for text, fractions and anything else."""
    kind = F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    return F.when(kind.isin(*_WHOLE), F.try_variant_get(v, path, "bigint"))


def _said(v: Column, path: str) -> Column:
    """A JSON string at path; null for anything else."""
    return F.when(F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING", F.try_variant_get(v, path, "string"))


def _is_null(v: Column, path: str) -> Column:
    """Nothing, or a JSON null, stands at path."""
    found = F.try_variant_get(v, path, "variant")
    return found.isNull() | F.is_variant_null(found)


def outcome(status: Column, body: Column, rules: str = "body_status") -> Column:
    """What a response amounts to, by the rules of its provider.

    `http` (errors come as HTTP statuses): 401, 403 and 429 have names, 422 with the whole-number code 42210000 is an entitlement,
    and the body of a success isn't judged. `body_status` (errors also come as successes with a status in the body): 403 is an
    entitlement; a success must be a JSON object whose status, if it has one, is exactly `ok` or `error`, and an error must have
    a whole-number code from 100 to 599, which then decides.
    """
    known = F.create_map(*(F.lit(x) for kv in HTTP_OUTCOMES.items() for x in kv))
    fine = status.between(200, 299)
    if rules == "http":
        return F.when(fine, "ok").when((status == 422) & (_whole(body, "$.code") == 42210000), "entitlement").otherwise(F.coalesce(known[status], F.lit("http_error")))
    if rules != "body_status":
        raise ValueError(f"unknown rules: {rules!r}")
    code, said = _whole(body, "$.code"), _said(body, "$.status")
    by_code = F.when(~F.coalesce(code.between(100, 599), F.lit(False)), "malformed_response").when(code == 403, "entitlement").otherwise(F.coalesce(known[code.cast("int")], F.lit("http_error")))
    return (
        F.when(status == 403, "entitlement")
        .when(~F.coalesce(fine, F.lit(False)), F.coalesce(known[status], F.lit("http_error")))
        .when(body.isNull(), "malformed_response")
        .when(_is_null(body, "$.status") | F.coalesce(said == "ok", F.lit(False)), "ok")
        .when(F.coalesce(said == "error", F.lit(False)), by_code)
        .otherwise("malformed_response")
    )


# What a preflight request for one identifier can amount to.
PREFLIGHT = {401: "authentication_failed", 403: "authentication_or_permission_denied", 429: "rate_limited"}


def preflight(responses: DataFrame) -> DataFrame:
    """Probe responses (status, body as VARIANT, identifier) with `preflight` and, where authorized, the number of `observations`.

    A 200 is authorized if `bars` is an object whose keys are all the requested identifier and whose values are arrays.
    """
    body, status = F.col("body"), F.col("status")
    kind = F.schema_of_variant(F.try_variant_get(body, "$.bars", "variant"))
    bars = F.try_variant_get(body, "$.bars", "map<string,variant>")
    entries = F.map_entries(bars)
    right = F.forall(entries, lambda e: (e["key"] == F.col("identifier")) & F.try_variant_get(e["value"], "$", "array<variant>").isNotNull())
    good = F.coalesce(kind.startswith("OBJECT") & right, F.lit(False))
    count = F.aggregate(entries, F.lit(0).cast("long"), lambda n, e: n + F.size(F.try_variant_get(e["value"], "$", "array<variant>")))
    known = F.create_map(*(F.lit(x) for kv in PREFLIGHT.items() for x in kv))
    found = (
        F.when(status == 200, F.when(good, "authorized").otherwise("malformed_response"))
        .when((status == 422) & (_whole(body, "$.code") == 42210000), "entitlement_denied")
        .otherwise(F.coalesce(known[status], F.lit("http_error")))
    )
    return responses.withColumns({"preflight": found, "observations": F.when((status == 200) & good, count)})


# Query keys that carry a credential, and the one key that a next link may have.
CREDENTIAL_KEYS = ("apikey", "api_key")
CURSOR_KEY = "cursor"


def _link_problem(link: Column, host: Column, endpoint: Column) -> Column:
    """The first thing wrong with a next link: it leaves the HTTPS origin, changes the path, carries a credential, or asks for more than one cursor."""
    part = lambda name: F.try_parse_url(link, F.lit(name))
    pairs = F.filter(F.split(F.coalesce(part("QUERY"), F.lit("")), "&"), lambda x: x != "")
    keys = F.transform(pairs, lambda x: F.lower(F.coalesce(F.try_url_decode(F.substring_index(x, "=", 1)), x)))
    value = F.regexp_extract(pairs[0], "^[^=]*=(.*)$", 1)
    away = ~F.coalesce((part("PROTOCOL") == "https") & (part("AUTHORITY") == host), F.lit(False)) | (F.coalesce(part("REF"), F.lit("")) != "")
    return (
        F.when(away, "host_drift")
        .when(~F.coalesce(part("PATH") == endpoint, F.lit(False)), "endpoint_drift")
        .when(F.arrays_overlap(keys, F.array(*map(F.lit, CREDENTIAL_KEYS))), "credential_key")
        .when((F.size(keys) != 1) | (F.try_element_at(keys, F.lit(1)) != CURSOR_KEY) | (value == ""), "extra_query")
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Pages (payload, host, endpoint) with what they say of the next one: `link` (a token or a URL; null at the end) and `problem`.

    A page says it by `next_page_token` (nothing, null or an empty text ends the chain) or by `next_url` (nothing or null ends it).
    """
    v = parsed(F.col("payload"))
    token, url = _said(v, "$.next_page_token"), _said(v, "$.next_url")
    odd = (~_is_null(v, "$.next_page_token") & token.isNull()) | (~_is_null(v, "$.next_url") & url.isNull())
    problem = F.when(v.isNull(), "invalid_json").when(odd, "token_type").when(url.isNotNull(), _link_problem(url, F.col("host"), F.col("endpoint")))
    return pages.withColumns({"link": F.coalesce(F.nullif(token, F.lit("")), url), "problem": problem})


def page_chain_audit(pages: DataFrame, most: int = 1000) -> DataFrame:
    """Requests (pages: request_id, page_number, payload, host, endpoint) whose chain of pages is broken, and how: request_id, problem.

    Besides what page_links() finds: a link that comes twice, page numbers that repeat or leave gaps, and more than `most` pages.
    Gaps follow from least, greatest and distinct page numbers; all counts are aggregated before they are shuffled, so a request with
    any number of pages is never sorted or held by one task.
    """
    x = page_links(pages).select("request_id", "page_number", "link", "problem")
    broken = x.filter("problem IS NOT NULL").select("request_id", "problem")
    repeated = x.filter("link IS NOT NULL").groupBy("request_id", "link").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("request_id", F.lit("repeated_token").alias("problem"))
    numbers = x.groupBy("request_id", "page_number").agg(F.count(F.lit(1)).alias("n")).groupBy("request_id").agg(F.sum("n").alias("n"), F.count("page_number").alias("d"), F.min("page_number").alias("a"), F.max("page_number").alias("z"))
    gaps = numbers.filter("n <> d OR z - a + 1 <> d").select("request_id", F.lit("page_gap").alias("problem"))
    many = numbers.filter(F.col("z") > most).select("request_id", F.lit("too_many_pages").alias("problem"))
    return broken.unionByName(repeated).unionByName(gaps).unionByName(many).distinct()


def runtime_summary(batches: DataFrame, provider: str | None = None) -> DataFrame:
    """Per provider: batches, datasets, statuses, and latency and limits from the stored metadata.

    With `provider`, a batch of another one (whatever its case) fails the query when it runs.
    """
    m = F.col("request_metadata")
    if provider is not None:
        other = F.lower("provider") != provider.strip().lower()
        batches = batches.withColumn("provider", F.when(other, F.raise_error(F.lit("a raw batch of another provider"))).otherwise(F.lit(provider.strip())))
    x = batches.select("provider", "dataset", safe_number(m["rate_limit_capacity"]).alias("capacity"), m["response_status"].alias("status"), safe_number(m["latency_ms"]).alias("latency"), safe_number(m["rate_limit_remaining"]).alias("remaining"), safe_number(m["api_credits_used"]).alias("credits"))
    return x.groupBy("provider").agg(
        F.count(F.lit(1)).alias("batches"), F.array_join(F.array_sort(F.collect_set("dataset")), ",").alias("datasets"), F.array_join(F.array_sort(F.collect_set("status")), ",").alias("statuses"),
        F.count("latency").alias("latencies"), F.sum("latency").alias("latency_sum"), F.max("latency").alias("latency_max"), F.min("remaining").alias("remaining_min"), F.max("credits").alias("credits_max"),
        F.array_join(F.transform(F.array_sort(F.collect_set("capacity")), lambda c: c.cast("long").cast("string")), ",").alias("capacities"),
    )
