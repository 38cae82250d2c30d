"""Provider pages to canonical bars and actions, with issues as a side output and whole-batch errors.

Three payload shapes carry bars: `results` (one ticker's records, epoch milliseconds), `symbol_map` (symbols to records,
RFC 3339) and `series` (per symbol a meta object and string values, naive UTC or plain dates). Two shapes carry actions:
`results` of one kind, and families of records. JSON is read as VARIANT, so numbers keep their digits; JSON with repeated
keys or NaN makes the batch an error. A page's request is in its columns: request_id, timeframe, start, end, session,
adjustment_state, daily_verified, adjusted (for results) and provider_identifier and instrument_id (single-ticker pages).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import new_york_date
from tidemark.functions.text import finite
from tidemark.operators.reconcile_actions import in_range
from tidemark.schemas import BAR_COLUMNS
from tidemark.sources.raw import parsed

# Severities of issue codes (the rest are errors).
SEVERITY = {"outside_requested_interval": "info", "outside_requested_session": "warning", "session_bounds_missing": "warning", "daily_semantics_unverified": "warning", "unsupported_corporate_action": "warning", "corporate_action_date_basis": "warning", "provider_definition": "info"}
#: What an issue of a code says.
MESSAGES = {
    "malformed_record": "the record lacks a readable time or number", "unmapped_instrument": "the symbol isn't one of the request", "provider_response_error": "the provider returned no usable series",
    "daily_semantics_unverified": "daily bars of this request aren't verified", "session_bounds_missing": "no session is known on that date", "outside_requested_session": "the bar lies outside the session", "outside_requested_interval": "the bar lies outside the requested interval",
    "unsupported_corporate_action": "the kind of action isn't supported", "incomplete_corporate_action": "the action lacks a needed value", "corporate_action_date_basis": "dates are on the provider's basis", "provider_definition": "inferred from the provider's definition",
}
_RFC = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?([Zz]|[+-]\d{2}:?\d{2})$"
_NAIVE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_MS_LIMIT = 253_402_300_799_999


@dataclass(frozen=True)
class Normalized:
    """What pages hold. `outcome`, if there is one, has all of it in one frame, so that one pass over the pages can keep it (see stored())."""

    rows: DataFrame
    issues: DataFrame
    batch_errors: DataFrame
    outcome: DataFrame | None = None


def split_outcome(outcome: DataFrame) -> Normalized:
    """Rows, issues and batch errors of an outcome frame: a row's `reason` tells an error of its page, its `code` an issue of its record."""
    good = outcome.filter("reason IS NULL")
    issues = good.filter("code IS NOT NULL").select("raw_batch_id", "code", "record_index", "severity", "message", "provider_record_id")
    return Normalized(good.filter("code IS NULL").select(*BAR_COLUMNS), issues, outcome.filter("reason IS NOT NULL").select("raw_batch_id", "reason"), outcome)


def stored(found: Normalized, path: str, leave_out: tuple[str, ...] = ()) -> Normalized:
    """The same, read from one written table, so that pages are parsed once however often rows, issues and errors are read.

    Columns to leave out are null in what is read back, and what only they need isn't computed.
    """
    if found.outcome is None:
        raise ValueError("this normalizer gives no outcome frame")
    schema, kept = found.outcome.schema, found.outcome.drop(*leave_out)
    kept.write.mode("overwrite").parquet(path, compression="zstd")
    read = found.outcome.sparkSession.read.schema(kept.schema).parquet(path)
    return split_outcome(read.withColumns({c: F.lit(None).cast(schema[c].dataType) for c in leave_out}).select(*schema.names))


_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def number(written: Column) -> Column:
    """A text that is a finite number as one, else null."""
    return F.when(written.rlike(_NUMBER), _let(written.try_cast("double"), lambda x: F.when(finite(x), x)))


def unparsable(v: Column, path: str) -> Column:
    """Something stands at path, but no finite number."""
    return text(v, path).isNotNull() & number(text(v, path)).isNull()


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with more columns, each computed once a row: filters on a generated column stay above it, where those on a projected one would compute it again.

    A lambda in one of them would have Spark interpret all of them, row by row.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def exact(v: Column, path: str) -> Column:
    """A decimal at path with all its digits; null if it has more than 18 behind the point or more than 20 before it, so nothing is rounded.

    Digits and exponent are read as they are written: 1e-20 is null, not 0.
    """

    def parts(written: Column) -> Column:
        part = lambda k: F.regexp_extract(written, r"^([+-]?)(\d*)\.?(\d*)(?:[eE]([+-]?\d{1,4}))?$", k)
        return F.struct(written.alias("text"), F.concat(part(2), part(3)).alias("digits"), (F.length(part(3)) - F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0))).alias("scale"))

    def judged(x: Column) -> Column:
        digits, scale = x["digits"], x["scale"]
        behind = scale - (F.length(digits) - F.length(F.regexp_replace(digits, "0+$", "")))
        before = F.length(F.regexp_replace(digits, "^0+", "")) - scale
        fits = (digits != "") & (digits.rlike("^0+$") | ((behind <= 18) & (before <= 20)))
        return F.when(fits, x["text"].try_cast("decimal(38,18)"))

    return _let(_let(F.trim(F.try_variant_get(v, path, "string")), parts), judged)


def text(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def day(v: Column, path: str) -> Column:
    return plain_date(text(v, path))


def plain_date(x: Column) -> Column:
    return F.when(x.rlike(_DATE), F.to_date(F.try_to_timestamp(x, F.lit("yyyy-MM-dd"))))


def epoch_ms(ms: Column, exact_ms: Column) -> Column:
    """Epoch milliseconds as an instant; null out of range, or if the number (read as a double too) isn't whole."""
    return F.when(ms.between(-62_135_596_800_000, _MS_LIMIT) & (exact_ms == ms), F.timestamp_millis(ms))


def rfc3339(c: Column) -> Column:
    return F.when(c.rlike(_RFC), c.try_cast("timestamp"))


def naive_utc(c: Column) -> Column:
    """Naive text as UTC; the session's zone must be UTC."""
    return F.when(c.rlike(_NAIVE), c.try_cast("timestamp"))


def request_mismatch(expected: Column, actual: Column) -> Column:
    """True unless every expected key is there with an equal value."""
    return F.exists(F.map_keys(expected), lambda k: ~expected[k].eqNullSafe(actual[k]))


def bind(pages: DataFrame, requests: DataFrame) -> DataFrame:
    """Pages with the columns of their request (request_id, source_id, expected_metadata, ...) and `reason`, null where all is well.

    A page must name a known request, come from the request's source and echo all metadata that the request expects. Bar
    normalizers take pages with a reason and make it the page's batch error.
    """
    own = [c for c in requests.columns if c not in ("request_id", "source_id", "expected_metadata")]
    r = requests.select("request_id", F.col("source_id").alias("_source"), F.col("expected_metadata").alias("_expected"), F.lit(True).alias("_known"), *own)
    x = pages.join(r, "request_id", "left")
    reason = F.when(F.col("_known").isNull(), "request").when(~F.col("source_id").eqNullSafe(F.col("_source")), "source").when(F.coalesce(request_mismatch(F.col("_expected"), F.col("request_metadata")), F.col("_expected").isNotNull()), "request_metadata")
    return x.withColumn("reason", reason).select(*pages.columns, *own, "reason")


def bound_pages(pages: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages that bind() finds well, and batch errors of the others."""
    x = bind(pages, requests)
    return x.filter("reason IS NULL").drop("reason"), x.filter("reason IS NOT NULL").select("raw_batch_id", "reason")


def chunk_identifiers(manifest: Column) -> Column:
    """Symbols that a page's request asked for, from its version-1 manifest; null if it is malformed, empty or repeats a symbol."""
    m = F.from_json(manifest, "version int, references array<struct<instrument_id: string, provider_identifier: string>>")
    names = F.transform(m["references"], lambda x: x["provider_identifier"])
    ok = (m["version"] == 1) & (F.size(names) > 0) & ~F.exists(names, lambda n: n.isNull() | (F.trim(n) == "")) & (F.size(F.array_distinct(names)) == F.size(names))
    return F.when(ok, names)


def checked_chunk(pages: DataFrame) -> DataFrame:
    """Pages with `chunk`, the symbols of their manifest, where it comes as text in `manifest_chunk`.

    A manifest that is malformed, has another fingerprint (SHA-256) than `chunk_fingerprint` says, or names a reference that
    isn't one of the request's (`request_references`: array of struct of instrument_id and provider_identifier) makes its page an error.
    """
    if "manifest_chunk" not in pages.columns:
        return pages
    m = F.from_json("manifest_chunk", "references array<struct<instrument_id: string, provider_identifier: string>>")["references"]
    chunk = chunk_identifiers(F.col("manifest_chunk"))
    known = F.forall(m, lambda r: F.exists("request_references", lambda q: (q["provider_identifier"] == r["provider_identifier"]) & (q["instrument_id"] == r["instrument_id"])))
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason")) if "reason" in pages.columns else F.when(F.lit(False), F.lit(None).cast("string"))
    ).when(chunk.isNull(), "chunk_manifest").when(~F.col("chunk_fingerprint").eqNullSafe(F.sha2("manifest_chunk", 256)), "chunk_fingerprint").when(~F.coalesce(known, F.lit(False)), "chunk_references")
    return pages.withColumns({"chunk": F.coalesce(chunk, F.array().cast("array<string>")), "reason": reason})


def single_references(pages: DataFrame, refs: DataFrame) -> DataFrame:
    """Pages of one ticker with the instrument of their identifier, and `reason` set where it hasn't exactly one match."""
    n = refs.groupBy("request_id", "provider_identifier").agg(F.count(F.lit(1)).alias("_n"), F.min("instrument_id").alias("instrument_id"))
    x = pages.join(n, ["request_id", "provider_identifier"], "left")
    return x.withColumn("reason", F.when(F.coalesce("_n", F.lit(0)) != 1, "instrument_reference")).drop("_n")


def _looked_up(rows: DataFrame, refs: DataFrame, symbol: str, name: str) -> DataFrame:
    """rows with `name`, the instrument of their symbol among their request's references, null if it has none.

    Rows without a symbol can't meet any, so they are dealt by their batch: else all of them would be one task.
    """
    known = refs.select("request_id", F.col("provider_identifier").alias("_key"), F.lit(True).alias("_keyed"), F.col("instrument_id").alias(name))
    keyed = rows.withColumns({"_key": F.coalesce(symbol, "raw_batch_id"), "_keyed": F.col(symbol).isNotNull()})
    return keyed.join(known, ["request_id", "_key", "_keyed"], "left").drop("_key", "_keyed")


def _record_type(stamp: str, names: dict[str, str]) -> str:
    """The type that one cast reads a list of records in: the time (results keep its JSON kind), and numbers as they are written."""
    return f"array<struct<{stamp}, {', '.join(f'{p}: string' for p in names.values())}>>"


def _typed(found: DataFrame, names: dict[str, str], times: dict[str, Column]) -> DataFrame:
    """found with its record (_r) as numbers and times, each read once a row by compiled code.

    `bad_number` tells that a volume or VWAP stands there, but no finite number; `malformed` that, or that a price lacks.
    """
    written = {k: F.col("_r")[p] for k, p in names.items()}
    x = _once(found, {f"_{k}": F.when(w.rlike(_NUMBER), w.try_cast("double")) for k, w in written.items()} | times)
    numbers = {k: F.when(finite(F.col(f"_{k}")), F.col(f"_{k}")) for k in names}
    bad, lacking = F.lit(False), F.lit(False)
    for k, c in numbers.items():
        if k in ("volume", "vwap"):
            bad = bad | (written[k].isNotNull() & c.isNull())
        else:
            lacking = lacking | c.isNull()
    more = {} if "vwap" in names else {"vwap": F.lit(None).cast("double")}
    return _once(x, {**numbers, "bad_number": bad, "malformed": bad | lacking}).withColumns(more).drop("_r", *(f"_{k}" for k in names))


_SHORT = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v", "vwap": "vw"}
_LONG = {"open": "open", "high": "high", "low": "low", "close": "close", "volume": "volume"}


def _without_reason(pages: DataFrame) -> DataFrame:
    return pages if "reason" in pages.columns else pages.withColumn("reason", F.lit(None).cast("string"))


def _records(x: DataFrame, columns: list[str], items: Column, index: str = "record_index") -> DataFrame:
    """One row for each item of good pages (`index` and _r), and one without an item for each page with a reason; pages without items leave."""
    found = x.select(*columns, F.posexplode_outer(F.when(F.col("reason").isNull(), items)).alias(index, "_r"))
    return found.filter(F.col("reason").isNotNull() | F.col(index).isNotNull())


def results_records(pages: DataFrame) -> DataFrame:
    """Records of one ticker's pages. Pages that already have a `reason` keep it."""
    pages = _without_reason(pages)
    x = _once(pages, {"_v": parsed(F.col("payload"))})
    adjusted = F.try_variant_get("_v", "$.adjusted", "boolean")
    items = F.try_variant_get("_v", "$.results", _record_type("t: variant", _SHORT))
    none = F.is_variant_null(F.coalesce(F.try_variant_get("_v", "$.results", "variant"), F.parse_json(F.lit("null"))))
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("_v").isNull(), "invalid_json")
        .when(~F.coalesce(text(F.col("_v"), "$.status") == "OK", F.lit(False)), "status")
        .when(~F.coalesce(adjusted == F.col("adjusted"), F.lit(False)), "adjusted_flag")
        .when(~F.coalesce(text(F.col("_v"), "$.ticker") == F.col("provider_identifier"), F.lit(False)), "ticker")
        .when(F.col("_items").isNull() & ~none, "results")
    )
    x = _once(_once(x, {"_items": items}), {"_reason": reason}).withColumn("reason", F.col("_reason"))
    stamp = F.col("_r")["t"]
    r = _once(_records(x, pages.columns, F.col("_items")), {"_ms": F.try_variant_get(stamp, "$", "bigint")})
    r = _typed(r, _SHORT, {"t": epoch_ms(F.col("_ms"), F.try_variant_get(stamp, "$", "double"))}).drop("_ms")
    return r.withColumns({"session_date": F.lit(None).cast("date"), "currency": F.lit(None).cast("string"), "series_issue": F.lit(None).cast("string"), "symbol": F.col("provider_identifier")})


def _starts(payload: Column) -> Column:
    """Symbols of a symbol map in the order of the document (`keys`), and how many records stand before each (`starts`).

    A reading without the records' fields gives both. One record or list of another kind leaves it without any, and the page is then read again.
    """
    body = F.decode(payload, "UTF-8")
    outline = F.from_json(body, "bars map<string,array<struct<>>>")["bars"]
    run_up = lambda sizes: F.aggregate(sizes, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + F.coalesce(n, F.lit(0))))
    listing = lambda keys, sizes: F.struct(keys.alias("keys"), run_up(sizes).alias("starts"))
    quick = _let(outline, lambda m: F.when(m.isNotNull(), listing(F.map_keys(m), F.transform(F.map_values(m), F.size))))
    lists = F.try_variant_get(parsed(payload), "$.bars", "map<string,array<variant>>")
    read_again = _let(lists, lambda m: _let(F.json_object_keys(F.get_json_object(body, "$.bars")), lambda keys: listing(keys, F.transform(keys, lambda k: F.size(m[k])))))
    return F.coalesce(quick, read_again)


def symbol_map_records(pages: DataFrame, refs: DataFrame) -> DataFrame:
    """Record indexes run across symbols in the order of the document.

    With a column `feed`, a page must come from the source of its feed (`feed_source_id`), or the page is in error.
    """
    pages = _without_reason(pages)
    # nothing but record_index needs the order of the document, so a query without it doesn't read that
    x = _once(pages.withColumn("_starts", _starts(F.col("payload"))), {"_v": parsed(F.col("payload"))})
    x = _once(x, {"_m": F.try_variant_get("_v", "$.bars", f"map<string,{_record_type('t: string', _SHORT)}>")})
    reason = F.when(F.col("reason").isNotNull(), F.col("reason"))
    if "feed_source_id" in pages.columns:
        reason = reason.when(~F.col("source_id").eqNullSafe(F.col("feed_source_id")), "source")
    reason = reason.when(F.col("_v").isNull(), "invalid_json").when(F.col("_m").isNull(), "bars")
    x = _once(x, {"_reason": reason}).withColumn("reason", F.col("_reason"))
    by_symbol = _records(x, [*pages.columns, "_starts"], F.map_entries("_m"), "_k").withColumns({"symbol": F.col("_r.key"), "_list": F.col("_r.value")})
    r = _records(by_symbol, [*pages.columns, "symbol", "_starts"], F.col("_list"), "_i")
    before = F.get(F.col("_starts.starts"), F.array_position("_starts.keys", F.col("symbol")).cast("int") - 1)
    r = r.withColumn("record_index", F.when(F.col("_i").isNotNull(), before + F.col("_i"))).select(*pages.columns, "symbol", "record_index", F.lit("USD").alias("currency"), "_r")
    r = _typed(r, _SHORT, {"t": rfc3339(F.col("_r.t"))}).withColumn("session_date", F.lit(None).cast("date"))
    r = _looked_up(r, refs, "symbol", "instrument_id")
    return r.withColumn("series_issue", F.when(F.col("instrument_id").isNull(), "unmapped_instrument"))


def series_records(pages: DataFrame, refs: DataFrame, interval: Column) -> DataFrame:
    """Records, and rows with a series_issue and no record for whole series: unusable ones and symbols that the response lacks.

    The symbols that a request asked for are in `chunk`, or in `manifest_chunk`, the request's reference manifest as text
    (see checked_chunk()), whose `chunk_fingerprint` is then checked too.
    """
    pages = _without_reason(checked_chunk(pages))
    series = f"struct<status: string, meta: struct<symbol: string, interval: string, currency: string>, values: {_record_type('datetime: string', _LONG)}>"
    x = _once(pages.withColumn("_all", F.json_object_keys(F.decode("payload", "UTF-8"))), {"_v": parsed(F.col("payload"))})  # _all is needed for record_index alone
    x = _once(x, {"_map": F.try_variant_get("_v", "$", f"map<string, {series}>")})
    x = _once(x, {"_single": F.arrays_overlap(F.map_keys("_map"), F.array(*map(F.lit, ("meta", "values", "status", "code", "message"))))})
    x = _once(x, {"_one": F.when(F.col("_single"), F.try_variant_get("_v", "$", series))})
    own, nothing = F.col("_one")["meta"]["symbol"], F.array().cast("array<string>")
    symbols = F.when(F.col("_single"), F.when(own.isNull(), nothing).otherwise(F.array(own))).otherwise(F.map_keys("_map"))
    reason = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("_v").isNull(), "invalid_json").when(F.col("_map").isNull(), "envelope")
    x = _once(x, {"_symbols": symbols, "_reason": reason}).withColumn("reason", F.col("_reason"))
    code = F.lit("provider_response_error")
    unusable = F.when(F.col("_single") & (F.size("_symbols") == 0), F.array(F.lit(None).cast("string"))).otherwise(nothing)
    # symbols of the response first, then those that it lacks
    listed = F.concat("_symbols", unusable, F.array_except("chunk", "_symbols"))
    s = _records(x, [*pages.columns, "_all", "_single", "_one", "_map", F.size("_symbols").alias("_own")], listed, "_p").withColumnRenamed("_r", "symbol")
    s = s.withColumns({"_there": F.coalesce(F.col("_p") < F.col("_own"), F.lit(False)), "_k": F.when(F.col("_p") < F.col("_own"), F.array_position("_all", F.col("symbol"))).otherwise(F.size("_all") + 1 + F.col("_p"))})
    s = _once(s, {"_s": F.when(F.col("_single"), F.col("_one")).otherwise(F.col("_map")[F.col("symbol")])})
    body = F.col("_s")
    meta = body["meta"]
    fault = (
        ~F.coalesce(body["status"] == "ok", F.lit(False)) | meta.isNull() | body["values"].isNull() | meta["symbol"].isNull() | meta["interval"].isNull()
        | F.coalesce(meta["symbol"] != F.col("symbol"), F.lit(False)) | F.coalesce(meta["interval"] != interval, F.lit(False))
    )
    daily = F.col("timeframe") == "1d"
    asked = F.coalesce(F.array_contains("chunk", F.col("symbol")), F.lit(False))
    usable = F.col("reason").isNull() & F.col("_there") & asked & ~fault
    s = _once(s, {"_asked": asked, "_fault": fault, "_values": F.when(usable, body["values"]), "currency": F.nullif(F.trim(meta["currency"]), F.lit(""))})
    r = s.select(*pages.columns, "symbol", "_k", "_there", "_asked", "_fault", "currency", F.posexplode_outer("_values").alias("_i", "_r"))
    stamp = F.col("_r.datetime")
    r = _typed(r, _LONG, {"t": F.when(~daily, naive_utc(stamp)), "session_date": F.when(daily, plain_date(stamp))})
    # only what is read of records meets the references
    r = _looked_up(r, refs, "symbol", "instrument_id")
    problem = F.when(F.col("reason").isNotNull(), F.lit(None).cast("string")).when(~F.col("_there"), code).when(F.col("instrument_id").isNull() | ~F.col("_asked"), "unmapped_instrument").when(F.col("_fault"), code)
    r = r.withColumn("series_issue", problem)
    whole, there = F.col("series_issue").isNotNull(), F.col("_i").isNotNull()
    r = r.filter(F.col("reason").isNotNull() | (whole & (F.coalesce("_i", F.lit(0)) == 0)) | (~whole & there))  # a whole series has one issue
    records = W.partitionBy("raw_batch_id").orderBy("_k", "_i").rowsBetween(W.unboundedPreceding, W.currentRow)
    r = r.withColumn("record_index", F.when(~whole & there, F.count_if(~whole & there).over(records) - 1).cast("int"))
    return r.drop("_k", "_i", "_there", "_asked", "_fault")


def classified(records: DataFrame, sessions: DataFrame, volume_required: bool = False) -> DataFrame:
    """Records with their canonical interval and session, or the code of the first check that fails.

    Sessions have one row a calendar day, a few hundred a year, so they are broadcast.
    """
    r = records.withColumn("session_date", F.coalesce("session_date", new_york_date(F.col("t"))))
    bounds = sessions.select("session_date", F.col("start").alias("_open"), F.col("end").alias("_close"))
    r = r.join(F.broadcast(bounds), "session_date", "left")
    daily = F.col("timeframe") == "1d"
    malformed = F.col("malformed") | F.col("session_date").isNull()
    if volume_required:
        malformed = malformed | F.col("volume").isNull()
    five_end = F.col("t") + F.expr("INTERVAL '5' MINUTE")
    free = ~daily & (F.col("session") == "unknown")
    begin = F.when(daily, F.col("_open")).otherwise(F.col("t"))
    end = F.when(daily, F.col("_close")).otherwise(five_end)
    code = (
        F.when(F.col("series_issue").isNotNull(), F.col("series_issue"))
        .when(malformed, "malformed_record")
        .when(daily & ~F.col("daily_verified"), "daily_semantics_unverified")
        .when(~free & F.col("_open").isNull(), "session_bounds_missing")
        .when(~daily & ~free & ((F.col("t") < F.col("_open")) | (five_end > F.col("_close"))), "outside_requested_session")
        .when((begin < F.col("start")) | (end > F.col("end")), "outside_requested_interval")
    )
    return r.withColumns({"issue_code": code, "timestamp_start": begin, "timestamp_end": end, "bar_session": F.when(free, "unknown").otherwise("regular")})


def _with_severity(issues: DataFrame) -> DataFrame:
    level = F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv))
    return issues.withColumn("severity", F.coalesce(level[F.col("code")], F.lit("error")))


def _outcome(c: DataFrame) -> Normalized:
    """Bars in canonical columns (provenance from the page), issues with severity and message, and batch errors, all of one frame.

    Issues and errors have no columns of bars, so that a written outcome holds each value for a reader.
    """
    level = F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv))
    said = F.create_map(*(F.lit(x) for kv in MESSAGES.items() for x in kv))
    code, wrong = F.col("issue_code"), F.col("reason").isNotNull()
    bars = {k: F.col(k) for k in BAR_COLUMNS if k in c.columns and k not in ("raw_batch_id", "session")} | {"session": F.col("bar_session"), "available_at": F.lit(None).cast("timestamp"), "quality_flags": F.array().cast("array<string>")}
    return split_outcome(
        c.select(
            "raw_batch_id", "reason", F.when(~wrong, code).alias("code"), F.when(~wrong, F.col("record_index")).cast("long").alias("record_index"), F.when(~wrong & code.isNotNull(), F.coalesce(level[code], F.lit("error"))).alias("severity"),
            F.when(~wrong & code.isNotNull(), said[code]).alias("message"), F.lit(None).cast("string").alias("provider_record_id"),
            *(F.when(~wrong & code.isNull(), bars[k]).alias(k) for k in BAR_COLUMNS if k in bars),
        )
    )


def normalize_results(pages: DataFrame, refs: DataFrame, sessions: DataFrame) -> Normalized:
    return _outcome(classified(results_records(single_references(pages, refs)), sessions))


def normalize_symbol_map(pages: DataFrame, refs: DataFrame, sessions: DataFrame) -> Normalized:
    return _outcome(classified(symbol_map_records(pages, refs), sessions))


def normalize_series(pages: DataFrame, refs: DataFrame, sessions: DataFrame) -> Normalized:
    interval = F.when(F.col("timeframe") == "1d", "1day").otherwise("5min")
    return _outcome(classified(series_records(pages, refs, interval), sessions))


#: Normalizers by payload shape: (pages, refs, sessions) -> Normalized. A new provider adds its own.
BAR_NORMALIZERS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], Normalized]] = {"results": normalize_results, "symbol_map": normalize_symbol_map, "series": normalize_series}

_ACTION_COLUMNS = ("split_ratio", "amount", "currency", "old_ticker", "new_ticker")


def _actions(c: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Actions and issues from classified action records."""
    rows = c.filter("issue_code IS NULL").select("action_type", "instrument_id", "effective_date", *_ACTION_COLUMNS, "source_id", "raw_batch_id", "provider_record_id")
    issues = c.filter("issue_code IS NOT NULL").select("raw_batch_id", F.col("issue_code").alias("code"), F.col("record_index").cast("long").alias("record_index"), "provider_record_id")
    return rows, _with_severity(issues)


def _nulls(*names: str) -> dict[str, Column]:
    kinds = {"split_ratio": "decimal(38,20)", "amount": "decimal(38,18)"}
    return {n: F.lit(None).cast(kinds.get(n, "string")) for n in names}


def _result_items(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    x = pages.withColumn("_v", parsed(F.col("payload")))
    x = x.withColumn("_items", F.try_variant_get("_v", "$.results", "array<variant>"))
    missing = F.try_variant_get("_v", "$.results", "variant").isNull()
    reason = F.when(F.col("_v").isNull(), "invalid_json").when(~F.coalesce(text(F.col("_v"), "$.status") == "OK", F.lit(False)), "status").when(F.col("_items").isNull() & ~missing, "results")
    x = x.withColumn("reason", reason)
    return x.filter("reason IS NULL").select(*pages.columns, F.posexplode("_items").alias("record_index", "_r")), x.filter("reason IS NOT NULL").select("raw_batch_id", "reason")


#: Digits behind the point of a ratio.
RATIO_DIGITS = 20


def ratio(to: Column, of: Column) -> Column:
    """Quotient of two positive decimals (38,18) with RATIO_DIGITS digits behind the point, the last one rounded, by long division.

    Both become whole numbers by the longer one's digits behind the point. Null where one isn't positive or such a number has
    more than 17 digits, which leaves a long room for a remainder and a digit.
    """
    div = lambda x, y: F.call_function("div", x, y)

    def tails(x: Column) -> Column:
        plain = {c: F.replace(F.format_number(x[c].cast("decimal(38,18)"), 18), F.lit(","), F.lit("")) for c in ("to", "of")}  # never in scientific notation
        return F.struct(*(F.struct(t.alias("t"), F.regexp_replace(F.substring_index(t, ".", -1), "0+$", "").alias("f")).alias(c) for c, t in plain.items()))

    def whole(x: Column) -> Column:
        digits = F.greatest(F.length(x["to"]["f"]), F.length(x["of"]["f"]))
        return F.struct(*(F.concat(F.substring_index(x[c]["t"], ".", 1), F.rpad(x[c]["f"], digits, F.lit("0"))).try_cast("bigint").alias(n) for c, n in (("to", "a"), ("of", "b"))))

    def divided(x: Column) -> Column:
        a, b = x["a"], x["b"]
        start = F.struct((a % b).alias("r"), F.lit("").alias("q"))
        behind = F.aggregate(F.sequence(F.lit(0), F.lit(RATIO_DIGITS)), start, lambda s, _: F.struct(((s["r"] * 10) % b).alias("r"), F.concat(s["q"], div(s["r"] * 10, b).cast("string")).alias("q")), lambda s: s["q"])
        found = F.concat(div(a, b).cast("string"), F.lit("."), behind).cast(f"decimal(38,{RATIO_DIGITS + 1})")
        return F.when(a.between(1, 10**17 - 1) & b.between(1, 10**17 - 1), F.round(found, RATIO_DIGITS))

    positive = _let(F.struct(to.alias("to"), of.alias("of")), lambda x: F.when((x["to"] > 0) & (x["of"] > 0), x))
    return _let(_let(_let(positive, tails), whole), divided).cast(f"decimal(38,{RATIO_DIGITS})")


def normalize_splits(pages: DataFrame) -> Normalized:
    """Checks in order: malformed, unsupported type, unmapped ticker, date out of range."""
    r, errors = _result_items(pages)
    v = F.col("_r")
    r = r.withColumns({"action_type": F.lit("split"), "effective_date": day(v, "$.execution_date"), "split_ratio": ratio(exact(v, "$.split_to"), exact(v, "$.split_from")), "provider_record_id": text(v, "$.id"), "_type": text(v, "$.adjustment_type"), "_ticker": text(v, "$.ticker"), **_nulls("amount", "currency", "old_ticker", "new_ticker")})
    bad = F.col("effective_date").isNull() | F.col("split_ratio").isNull() | F.col("_type").isNull() | F.col("_ticker").isNull()
    code = (
        F.when(bad, "malformed_record")
        .when(~F.col("_type").isin("forward_split", "reverse_split"), "unsupported_corporate_action")
        .when(F.col("_ticker") != F.col("provider_identifier"), "unmapped_instrument")
        .when(~in_range(F.col("effective_date"), F.col("start_date"), F.col("end_date")), "outside_requested_interval")
    )
    rows, issues = _actions(r.withColumn("issue_code", code))
    return Normalized(rows, issues, errors)


def normalize_dividends(pages: DataFrame) -> Normalized:
    """Checks in order: incomplete, unmapped ticker, date out of range, currency that isn't a code."""
    r, errors = _result_items(pages)
    v = F.col("_r")
    r = r.withColumns({"action_type": F.lit("dividend"), "effective_date": day(v, "$.ex_dividend_date"), "amount": exact(v, "$.cash_amount"), "currency": F.upper(text(v, "$.currency")), "provider_record_id": text(v, "$.id"), "_ticker": text(v, "$.ticker"), **_nulls("split_ratio", "old_ticker", "new_ticker")})
    bad = F.col("effective_date").isNull() | ~F.coalesce(F.col("amount") > 0, F.lit(False)) | F.col("currency").isNull() | F.col("_ticker").isNull()
    code = (
        F.when(bad, "incomplete_corporate_action")
        .when(F.col("_ticker") != F.col("provider_identifier"), "unmapped_instrument")
        .when(~in_range(F.col("effective_date"), F.col("start_date"), F.col("end_date")), "outside_requested_interval")
        .when(~F.col("currency").rlike("^[A-Z]{3}$"), "incomplete_corporate_action")
    )
    rows, issues = _actions(r.withColumn("issue_code", code))
    return Normalized(rows, issues, errors)


def normalize_ticker_events(pages: DataFrame) -> Normalized:
    """Consecutive events of a batch's timeline become changes; each tells that it was inferred.

    A timeline without the batch's ticker, or with two tickers on a date, is a batch error; an empty one is an issue.
    """
    x = pages.withColumn("_v", parsed(F.col("payload")))
    reason = F.when(F.col("_v").isNull(), "invalid_json").when(~F.coalesce(text(F.col("_v"), "$.status") == "OK", F.lit(False)), "status").when(F.try_variant_get("_v", "$.results", "map<string,variant>").isNull(), "results")
    x = x.withColumns({"reason": reason, "_items": F.try_variant_get("_v", "$.results.events", "array<variant>")})
    errors = x.filter("reason IS NOT NULL").select("raw_batch_id", "reason")
    e = x.filter("reason IS NULL").select(*pages.columns, F.posexplode_outer("_items").alias("record_index", "_r"))
    v = F.col("_r")
    e = e.withColumns({"_date": day(v, "$.date"), "_ticker": F.nullif(text(v, "$.ticker_change.ticker"), F.lit(""))})
    usable = F.col("_date").isNotNull() & F.col("_ticker").isNotNull() & F.coalesce(text(v, "$.type") == "ticker_change", F.lit(False))
    e = e.withColumn("_ok", usable).drop("_r")
    malformed = e.filter("record_index IS NOT NULL AND NOT _ok").select("raw_batch_id", F.lit("malformed_record").alias("code"), F.col("record_index").cast("long").alias("record_index"))
    batch = e.groupBy("raw_batch_id").agg(F.count_if("_ok").alias("_n"), F.bool_or(F.col("_ok") & (F.col("_ticker") == F.col("provider_identifier"))).alias("_anchored"))
    dates = e.filter("_ok").groupBy("raw_batch_id", "_date").agg(F.count_distinct("_ticker").alias("_k")).groupBy("raw_batch_id").agg(F.max("_k").alias("_most"))
    judged = batch.join(dates, "raw_batch_id", "left").withColumn("reason", F.when(F.col("_n") == 0, None).when(~F.col("_anchored"), "anchor").when(F.col("_most") > 1, "ambiguous_timeline"))
    errors = errors.unionByName(judged.filter("reason IS NOT NULL").select("raw_batch_id", "reason"))
    empty = judged.filter("_n = 0").select("raw_batch_id", F.lit("provider_definition").alias("code"), F.lit(None).cast("long").alias("record_index"))
    good = e.filter("_ok").join(judged.filter("reason IS NULL AND _n > 0").select("raw_batch_id"), "raw_batch_id", "left_semi")
    old = F.lag("_ticker").over(W.partitionBy("raw_batch_id").orderBy("_date", "_ticker"))
    pairs = good.withColumn("old_ticker", old).filter((F.lower("old_ticker") != F.lower("_ticker")) & in_range(F.col("_date"), F.col("start_date"), F.col("end_date")))
    rows = pairs.withColumns({"action_type": F.lit("ticker_change"), "effective_date": F.col("_date"), "new_ticker": F.col("_ticker"), "provider_record_id": F.lit(None).cast("string"), **_nulls("split_ratio", "amount", "currency")})
    rows = rows.select("action_type", "instrument_id", "effective_date", *_ACTION_COLUMNS, "source_id", "raw_batch_id", "provider_record_id")
    told = rows.select("raw_batch_id", F.lit("provider_definition").alias("code"), F.lit(None).cast("long").alias("record_index"))
    return Normalized(rows, _with_severity(malformed.unionByName(empty).unionByName(told)), errors)


def normalize_families(pages: DataFrame, refs: DataFrame) -> Normalized:
    """Families of records in one object; each batch also gets a warning that dates are on the provider's basis."""
    body = F.decode("payload", "UTF-8")
    x = pages.withColumn("_v", parsed(F.col("payload")))
    x = x.withColumns({"_m": F.try_variant_get("_v", "$.corporate_actions", "map<string,array<variant>>"), "_keys": F.json_object_keys(F.get_json_object(body, "$.corporate_actions"))})
    x = x.withColumn("reason", F.when(F.col("_v").isNull(), "invalid_json").when(F.col("_m").isNull(), "corporate_actions"))
    errors = x.filter("reason IS NOT NULL").select("raw_batch_id", "reason")
    ok = x.filter("reason IS NULL")
    basis = ok.select("raw_batch_id", F.lit("corporate_action_date_basis").alias("code"), F.lit(None).cast("long").alias("record_index"), F.lit(None).cast("string").alias("provider_record_id"))
    f = ok.select(*pages.columns, "_m", F.posexplode("_keys").alias("_k", "family"))
    r = f.select(*pages.columns, "_k", "family", F.posexplode(F.col("_m")[F.col("family")]).alias("_i", "_r"))
    r = r.withColumn("record_index", F.row_number().over(W.partitionBy("raw_batch_id").orderBy("_k", "_i")) - 1)
    v, family = F.col("_r"), F.col("family")
    split, cash, name = family.isin("forward_splits", "reverse_splits"), family == "cash_dividends", family == "name_changes"
    r = r.withColumns(
        {
            "action_type": F.when(split, "split").when(cash, "dividend").when(name, "ticker_change"),
            "provider_record_id": text(v, "$.id"),
            "effective_date": F.when(name, day(v, "$.effective_date")).otherwise(day(v, "$.ex_date")),
            "_processed": day(v, "$.process_date"),
            "split_ratio": F.when(split, ratio(exact(v, "$.new_rate"), exact(v, "$.old_rate"))),
            "amount": F.when(cash, exact(v, "$.rate")),
            "currency": F.when(cash, F.upper(text(v, "$.currency"))),
            "_symbol": F.when(name, text(v, "$.new_symbol")).otherwise(text(v, "$.symbol")),
            "old_ticker": F.when(name, text(v, "$.old_symbol")),
            "new_ticker": F.when(name, text(v, "$.new_symbol")),
        }
    ).drop("_r", "_k", "_i")
    r = _looked_up(_looked_up(r, refs, "_symbol", "_by_new"), refs, "old_ticker", "_by_old").withColumn("instrument_id", F.coalesce("_by_new", "_by_old"))
    lacking = (
        F.when(split, F.col("_symbol").isNull() | F.col("split_ratio").isNull() | F.col("effective_date").isNull())
        .when(cash, F.col("_symbol").isNull() | ~F.coalesce(F.col("amount") > 0, F.lit(False)) | F.col("effective_date").isNull())
        .when(name, F.col("old_ticker").isNull() | F.col("new_ticker").isNull())
    )
    incomplete = F.lit("incomplete_corporate_action")
    code = (
        F.when(F.col("action_type").isNull(), "unsupported_corporate_action")
        .when(lacking, incomplete)
        .when(name & F.col("effective_date").isNull(), incomplete)
        .when(F.col("instrument_id").isNull(), "unmapped_instrument")
        .when(cash & F.col("currency").isNull(), incomplete)
        .when(~in_range(F.col("effective_date"), F.col("start_date"), F.col("end_date")), "outside_requested_interval")
        .when(cash & ~F.col("currency").rlike("^[A-Z]{3}$"), incomplete)
        .when(name & (F.lower("old_ticker") == F.lower("new_ticker")), incomplete)
    )
    rows, issues = _actions(r.withColumn("issue_code", code))
    return Normalized(rows, issues.unionByName(_with_severity(basis)), errors)


#: Action normalizers of single-ticker pages by endpoint.
ACTION_ENDPOINTS: dict[str, Callable[[DataFrame], Normalized]] = {"splits": normalize_splits, "dividends": normalize_dividends, "ticker_events": normalize_ticker_events}


def normalize_by_endpoint(pages: DataFrame, sources: DataFrame | None = None) -> Normalized:
    """Actions of pages with a column `endpoint`; a page of an endpoint without a normalizer is a batch error.

    With `sources` (endpoint, source_id; see source_dimension()), a page that comes from none of its endpoint's sources is one too.
    """
    known = F.coalesce(F.col("endpoint").isin(*ACTION_ENDPOINTS), F.lit(False))
    reason = F.when(~known, "endpoint")
    x = pages
    if sources is not None:
        x = x.join(sources.groupBy("endpoint").agg(F.collect_set("source_id").alias("_sources")), "endpoint", "left")
        reason = reason.when(~F.coalesce(F.array_contains("_sources", F.col("source_id")), F.lit(False)), "source")
    x = x.withColumn("_reason", reason).select(*pages.columns, "_reason")
    refused = x.filter("_reason IS NOT NULL").select("raw_batch_id", F.col("_reason").alias("reason"))
    good = x.filter("_reason IS NULL").drop("_reason")
    parts = [f(good.filter(F.col("endpoint") == k).drop("endpoint")) for k, f in ACTION_ENDPOINTS.items()]
    rows, issues, errors = parts[0].rows, parts[0].issues, parts[0].batch_errors.unionByName(refused)
    for p in parts[1:]:
        rows, issues, errors = rows.unionByName(p.rows), issues.unionByName(p.issues, allowMissingColumns=True), errors.unionByName(p.batch_errors)
    return Normalized(rows, issues, errors)
