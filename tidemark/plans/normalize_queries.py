"""Queries that build provider pages from the sample tables and normalize them again."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.action_queries import CALENDAR, _calendar
from tidemark.plans.adapters import table
from tidemark.sources import normalize as nz

_START, _END = "1996-01-01 00:00:00", "2000-01-01 00:00:00"


def _requested(pages, timeframe: str):
    return pages.withColumns(
        {
            "request_id": F.lit("r1"), "timeframe": F.lit(timeframe), "start": F.lit(_START).cast("timestamp"), "end": F.lit(_END).cast("timestamp"), "session": F.lit("regular"), "adjustment_state": F.lit("unadjusted"),
            "daily_verified": F.lit(True), "adjusted": F.lit(False), "source_id": F.lit("s"), "retrieved_at": F.lit(_END).cast("timestamp"), "ingested_at": F.lit(_END).cast("timestamp"),
        }
    )


def _lines(spark, sf_dir, by: str | None = None):
    """Lines with their prices and time; dealt by `by`, so that lists within lists of that key need no further shuffle."""
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax", "l_shipdate")
    x = x.repartition(by) if by else x
    n = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    p = F.col("l_extendedprice") / F.col("l_quantity")
    at = F.col("l_shipdate") + F.expr("INTERVAL '5' MINUTE") * (162 + F.col("l_orderkey") % 78)
    return x.withColumns({"n": n, "p": p, "at": at.cast("timestamp"), "symbol": F.concat(F.lit("S"), F.col("l_partkey").cast("string")), "close": F.when(n % 37 != 0, p * (1 + F.col("l_tax"))), "high": p * (1 + F.col("l_tax"))})


def _listed(order: str, record):
    """A group's records in order, by compiled code: there is no lambda."""
    return F.sort_array(F.collect_list(F.struct(order, record.alias("r"))))["r"]


def _refs(spark, sf_dir):
    parts = table(spark, sf_dir, "lineitem").select("l_partkey").distinct().filter("l_partkey % 50 <> 0")
    return parts.select(F.lit("r1").alias("request_id"), F.concat(F.lit("S"), F.col("l_partkey").cast("string")).alias("provider_identifier"), F.col("l_partkey").cast("string").alias("instrument_id"))


def symbol_map_pages(spark, sf_dir):
    rec = F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), F.col("p").alias("o"), F.col("high").alias("h"), F.col("p").alias("l"), F.col("close").alias("c"), F.col("l_quantity").alias("v"))
    per = _lines(spark, sf_dir, "l_orderkey").groupBy("l_orderkey", "symbol").agg(_listed("n", rec).alias("v"))
    page = per.groupBy("l_orderkey").agg(F.to_json(F.struct(F.map_from_entries(F.sort_array(F.collect_list(F.struct("symbol", "v")))).alias("bars"))).alias("j"))
    pages = page.select(F.concat(F.lit("b"), F.col("l_orderkey").cast("string")).alias("raw_batch_id"), F.encode("j", "UTF-8").alias("payload"))
    return _requested(pages, "5m")


def symbol_map(spark, sf_dir):
    return nz.normalize_symbol_map(symbol_map_pages(spark, sf_dir), _refs(spark, sf_dir), _calendar(spark, sf_dir))


def results(spark, sf_dir):
    k = F.col("l_partkey")
    rec = F.struct(F.unix_millis("at").alias("t"), F.col("p").alias("o"), F.col("high").alias("h"), F.col("p").alias("l"), F.col("close").alias("c"), F.col("l_quantity").alias("v"))
    per = _lines(spark, sf_dir).groupBy("l_partkey").agg(_listed("n", rec).alias("results"))
    body = F.to_json(F.struct(F.concat(F.lit("S"), F.when(k % 47 == 0, k + 1).otherwise(k).cast("string")).alias("ticker"), F.when(k % 51 == 0, "ERROR").otherwise("OK").alias("status"), (k % 53 == 0).alias("adjusted"), "results"))
    pages = per.select(F.concat(F.lit("p"), k.cast("string")).alias("raw_batch_id"), F.concat(F.lit("S"), k.cast("string")).alias("provider_identifier"), F.encode(body, "UTF-8").alias("payload"))
    return nz.normalize_results(_requested(pages, "5m"), _refs(spark, sf_dir), _calendar(spark, sf_dir))


def series(spark, sf_dir):
    s = lambda c: F.col(c).cast("string")
    rec = F.struct(F.date_format("at", "yyyy-MM-dd").alias("datetime"), s("p").alias("open"), s("high").alias("high"), s("p").alias("low"), s("close").alias("close"), s("l_quantity").alias("volume"))
    per = _lines(spark, sf_dir, "l_orderkey").groupBy("l_orderkey", "l_partkey", "symbol").agg(_listed("n", rec).alias("values"))
    k = F.col("l_orderkey") + F.col("l_partkey")
    one = F.struct(F.struct("symbol", F.when(k % 43 == 0, "5min").otherwise("1day").alias("interval"), F.when(k % 3 == 0, "USD").alias("currency")).alias("meta"), "values", F.when(k % 41 == 0, "error").otherwise("ok").alias("status"))
    page = per.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("symbol", one.alias("x")))).alias("all"))
    body = F.when(F.size("all") == 1, F.to_json(F.col("all")[0]["x"])).otherwise(F.to_json(F.map_from_entries("all")))
    chunk = F.concat(F.col("all")["symbol"], F.when(F.col("l_orderkey") % 10 == 0, F.array(F.lit("S-none"))).otherwise(F.array().cast("array<string>")))
    pages = page.select(F.concat(F.lit("b"), F.col("l_orderkey").cast("string")).alias("raw_batch_id"), chunk.alias("chunk"), F.encode(body, "UTF-8").alias("payload"))
    return nz.normalize_series(_requested(pages, "1d"), _refs(spark, sf_dir), _calendar(spark, sf_dir))


def _bars(x):
    return x.rows.select("raw_batch_id", "instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), F.unix_micros("timestamp_end").alias("end_us"), "open", "high", "close", "volume", "currency", "session")


SHAPES = {"results": results, "symbol_map": symbol_map, "series": series}


def normalization_issues(spark, sf_dir):
    parts = [f(spark, sf_dir).issues.groupBy("code", "severity").agg(F.count(F.lit(1)).alias("issues"), F.count_distinct("raw_batch_id").alias("batches")).withColumn("shape", F.lit(k)) for k, f in SHAPES.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def normalization_errors(spark, sf_dir):
    return results(spark, sf_dir).batch_errors.groupBy("reason").agg(F.count(F.lit(1)).alias("batches"))


def _orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.withColumns({"k": F.col("o_orderkey"), "d": F.date_format("o_orderdate", "yyyy-MM-dd"), "sym": F.concat(F.lit("C"), F.col("o_custkey").cast("string"))})


def _action_pages(spark, sf_dir, kind: int, record):
    """A page of one customer's orders of a kind."""
    o = _orders(spark, sf_dir).filter(F.col("k") % 3 == kind)
    per = o.groupBy("o_custkey").agg(_listed("k", record).alias("items"))
    return per.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("raw_batch_id"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("provider_identifier"), F.col("o_custkey").cast("string").alias("instrument_id"), F.lit("s").alias("source_id"), F.lit("r1").alias("request_id"), F.lit("1996-01-01").cast("date").alias("start_date"), F.lit("2000-01-01").cast("date").alias("end_date"), F.col("o_custkey"), "items")


def _payload(pages):
    return pages.withColumn("payload", F.encode(F.to_json(F.struct(F.when(F.col("o_custkey") % 97 == 0, "BAD").otherwise("OK").alias("status"), F.col("items").alias("results"))), "UTF-8")).drop("items", "o_custkey")


def _ticker(k):
    return F.when(k % 11 == 0, "OTHER").otherwise(F.col("sym"))


def _rate(k):
    """Whole rates, some with twelve digits behind the point, some so small that they can't be kept exactly, some missing."""
    whole = (k % 5 + 1).cast("string")
    return F.when(k % 13 == 0, None).when(k % 43 == 0, "1e-20").when(k % 10 == 6, F.concat(whole, F.lit(".000000000001"))).otherwise(whole)


def splits(spark, sf_dir):
    """Splits with their ratios to the last digit."""
    x = splits_normalized(spark, sf_dir)
    return x.rows.select("instrument_id", F.date_format("effective_date", "yyyy-MM-dd").alias("effective_date"), F.col("split_ratio").cast("string").alias("split_ratio"), "provider_record_id", "source_id")


def splits_pages(spark, sf_dir):
    k = F.col("k")
    rec = F.struct(k.cast("string").alias("id"), _ticker(k).alias("ticker"), F.col("d").alias("execution_date"), F.when(k % 7 == 0, "stock_dividend").when(k % 2 == 0, "forward_split").otherwise("reverse_split").alias("adjustment_type"), (k % 4 + 1).alias("split_from"), _rate(k).alias("split_to"))
    return _payload(_action_pages(spark, sf_dir, 0, rec))


def splits_normalized(spark, sf_dir):
    return nz.normalize_splits(splits_pages(spark, sf_dir))


def dividends_pages(spark, sf_dir):
    k = F.col("k")
    rec = F.struct(k.cast("string").alias("id"), _ticker(k).alias("ticker"), F.col("d").alias("ex_dividend_date"), F.when(k % 13 == 0, 0).otherwise(F.col("o_totalprice")).alias("cash_amount"), F.when(k % 17 == 0, "DOLLAR").otherwise("usd").alias("currency"))
    return _payload(_action_pages(spark, sf_dir, 1, rec))


def dividends_normalized(spark, sf_dir):
    return nz.normalize_dividends(dividends_pages(spark, sf_dir))


def events_pages(spark, sf_dir):
    k = F.col("k")
    rec = F.struct(F.col("d").alias("date"), F.when(k % 19 == 0, "rename").otherwise("ticker_change").alias("type"), F.struct(F.when(k % 4 == 0, F.col("sym")).otherwise(F.concat(F.lit("N"), (k % 4).cast("string"))).alias("ticker")).alias("ticker_change"))
    pages = _action_pages(spark, sf_dir, 2, rec)
    return pages.withColumn("payload", F.encode(F.to_json(F.struct(F.lit("OK").alias("status"), F.struct(F.lit("x").alias("name"), F.col("items").alias("events")).alias("results"))), "UTF-8")).drop("items", "o_custkey")


def events_normalized(spark, sf_dir):
    return nz.normalize_ticker_events(events_pages(spark, sf_dir))


def families_pages(spark, sf_dir):
    """Pages of all kinds of a customer's orders, and the references of their request."""
    k = F.col("k")
    o = _orders(spark, sf_dir)
    family = F.when(k % 29 == 0, "spin_offs").when(k % 3 == 0, "forward_splits").when(k % 3 == 1, "cash_dividends").otherwise("name_changes")
    rec = F.struct(
        k.cast("string").alias("id"), F.when(k % 3 != 2, _ticker(k)).alias("symbol"), F.when(k % 3 != 2, F.col("d")).alias("ex_date"), F.when(k % 3 == 0, k % 5 + 1).alias("new_rate"), F.when((k % 3 == 0) & (k % 13 != 0), k % 4 + 1).alias("old_rate"),
        F.when(k % 3 == 1, F.col("o_totalprice")).alias("rate"), F.when((k % 3 == 1) & (k % 17 != 0), "USD").alias("currency"), F.when(k % 3 == 2, _ticker(k)).alias("old_symbol"), F.when(k % 3 == 2, F.concat(F.lit("M"), k.cast("string"))).alias("new_symbol"),
        F.when(k % 3 == 2, F.col("d")).alias("process_date"), F.when((k % 3 == 2) & (k % 5 != 0), F.col("d")).alias("effective_date"),
    )
    per = o.groupBy("o_custkey", family.alias("f")).agg(_listed("k", rec).alias("v"))
    page = per.groupBy("o_custkey").agg(F.to_json(F.struct(F.map_from_entries(F.sort_array(F.collect_list(F.struct("f", "v")))).alias("corporate_actions"))).alias("j"))
    pages = page.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("raw_batch_id"), F.lit("s").alias("source_id"), F.lit("r1").alias("request_id"), F.lit("1996-01-01").cast("date").alias("start_date"), F.lit("2000-01-01").cast("date").alias("end_date"), F.encode("j", "UTF-8").alias("payload"))
    refs = o.select(F.lit("r1").alias("request_id"), F.col("sym").alias("provider_identifier"), F.col("o_custkey").cast("string").alias("instrument_id")).distinct()
    return pages, refs


def families_normalized(spark, sf_dir):
    return nz.normalize_families(*families_pages(spark, sf_dir))


def _acts(x):
    return x.rows.select("action_type", "instrument_id", F.date_format("effective_date", "yyyy-MM-dd").alias("effective_date"), F.round(F.col("split_ratio").cast("double"), 10).alias("split_ratio"), F.col("amount").cast("double").alias("amount"), "currency", "old_ticker", "new_ticker", "provider_record_id")


def action_issues(spark, sf_dir):
    found = {"splits": splits_normalized, "dividends": dividends_normalized, "events": events_normalized, "families": families_normalized}
    out = None
    for k, f in found.items():
        x = f(spark, sf_dir)
        y = x.issues.groupBy(F.col("code"), "severity").agg(F.count(F.lit(1)).alias("rows")).unionByName(x.batch_errors.groupBy(F.col("reason").alias("code")).agg(F.count(F.lit(1)).alias("rows")).withColumn("severity", F.lit("batch"))).withColumn("kind", F.lit(k))
        out = y if out is None else out.unionByName(y)
    return out


_LINE = CALENDAR + """, li AS (SELECT *, l_orderkey * 8 + l_linenumber AS n, l_extendedprice / l_quantity AS p, epoch_us(l_shipdate + (INTERVAL 5 MINUTE) * (162 + l_orderkey % 78)) AS t FROM lineitem LEFT JOIN cal ON d = CAST(l_shipdate AS DATE)),
lim AS (SELECT epoch_us(TIMESTAMP '1996-01-01') AS a, epoch_us(TIMESTAMP '2000-01-01') AS b)"""
_FIVE = "CASE WHEN s IS NULL THEN 'session_bounds_missing' WHEN t < s OR t + 300000000 > e THEN 'outside_requested_session' WHEN t < a OR t + 300000000 > b THEN 'outside_requested_interval' END"
_CODES = _LINE + f""", j AS (SELECT *, CASE WHEN l_partkey % 50 = 0 THEN 'unmapped_instrument' WHEN n % 37 = 0 THEN 'malformed_record' ELSE {_FIVE} END AS mc,
  CASE WHEN l_partkey % 50 = 0 OR l_partkey % 51 = 0 OR l_partkey % 53 = 0 OR l_partkey % 47 = 0 THEN 'batch' WHEN n % 37 = 0 THEN 'malformed_record' ELSE {_FIVE} END AS rc,
  CASE WHEN l_partkey % 50 = 0 OR (l_orderkey + l_partkey) % 41 = 0 OR (l_orderkey + l_partkey) % 43 = 0 THEN 'series' WHEN n % 37 = 0 THEN 'malformed_record' WHEN s IS NULL THEN 'session_bounds_missing' WHEN s < a OR e > b THEN 'outside_requested_interval' END AS sc FROM li, lim)"""
_NUMS = "p AS open, p * (1 + l_tax) AS high, p * (1 + l_tax) AS close, l_quantity AS volume"
_SEV = "CASE WHEN code IN ('outside_requested_interval', 'provider_definition') THEN 'info' WHEN code IN ('outside_requested_session', 'session_bounds_missing', 'unsupported_corporate_action', 'corporate_action_date_basis') THEN 'warning' ELSE 'error' END AS severity"
_AO = """WITH o AS (SELECT *, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, 'C' || o_custkey AS sym, o_orderkey % 11 = 0 AS other, CAST(o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o_orderdate AS DATE) < DATE '2000-01-01' AS inside FROM orders),
sp AS (SELECT *, CASE WHEN k % 13 = 0 OR k % 43 = 0 THEN 'malformed_record' WHEN k % 7 = 0 THEN 'unsupported_corporate_action' WHEN other THEN 'unmapped_instrument' WHEN NOT inside THEN 'outside_requested_interval' END AS code FROM o WHERE k % 3 = 0 AND o_custkey % 97 <> 0),
dv AS (SELECT *, CASE WHEN k % 13 = 0 THEN 'incomplete_corporate_action' WHEN other THEN 'unmapped_instrument' WHEN NOT inside THEN 'outside_requested_interval' WHEN k % 17 = 0 THEN 'incomplete_corporate_action' END AS code FROM o WHERE k % 3 = 1 AND o_custkey % 97 <> 0),
ev AS (SELECT *, CASE WHEN k % 4 = 0 THEN sym ELSE 'N' || (k % 4) END AS tick, k % 19 <> 0 AS ok FROM o WHERE k % 3 = 2),
evb AS (SELECT o_custkey, count(*) FILTER (ok) AS n, bool_or(ok AND tick = sym) AS anchored, max(m) AS most FROM (SELECT *, count(DISTINCT CASE WHEN ok THEN tick END) OVER (PARTITION BY o_custkey, d) AS m FROM ev) GROUP BY 1),
evp AS (SELECT ev.*, lag(tick) OVER (PARTITION BY ev.o_custkey ORDER BY d, tick) AS old FROM ev JOIN evb ON ev.o_custkey = evb.o_custkey AND n > 0 AND anchored AND most = 1 WHERE ok),
evr AS (SELECT * FROM evp WHERE lower(old) <> lower(tick) AND inside),
fm AS (SELECT *, CASE WHEN k % 29 = 0 THEN 'unsupported_corporate_action' WHEN k % 3 = 0 AND k % 13 = 0 THEN 'incomplete_corporate_action' WHEN k % 3 = 2 AND k % 5 = 0 THEN 'incomplete_corporate_action' WHEN other THEN 'unmapped_instrument' WHEN k % 3 = 1 AND k % 17 = 0 THEN 'incomplete_corporate_action' WHEN NOT inside THEN 'outside_requested_interval' END AS code FROM o)
"""
_RATIO = "round(CAST({a} AS DOUBLE) / {b}, 10)"


def _act(kind, ratio="NULL", amount="NULL", currency="NULL", old="NULL", new="NULL", key="k::VARCHAR", src="", where="code IS NULL"):
    return f"SELECT '{kind}' AS action_type, o_custkey::VARCHAR AS instrument_id, strftime(d, '%Y-%m-%d') AS effective_date, {ratio}::DOUBLE AS split_ratio, {amount}::DOUBLE AS amount, {currency}::VARCHAR AS currency, {old}::VARCHAR AS old_ticker, {new}::VARCHAR AS new_ticker, {key} AS provider_record_id FROM {src} WHERE {where}"


_SPLIT = _RATIO.format(a="(k % 5 + 1)", b="(k % 4 + 1)")
QUERIES = {
    "normalize_a_bars": (lambda s, d: _bars(results(s, d)), _CODES + f" SELECT 'p' || l_partkey AS raw_batch_id, l_partkey::VARCHAR AS instrument_id, '5m' AS timeframe, t AS start_us, t + 300000000 AS end_us, {_NUMS}, NULL::VARCHAR AS currency, 'regular' AS session FROM j WHERE rc IS NULL"),
    "normalize_b_bars": (lambda s, d: _bars(symbol_map(s, d)), _CODES + f" SELECT 'b' || l_orderkey AS raw_batch_id, l_partkey::VARCHAR AS instrument_id, '5m' AS timeframe, t AS start_us, t + 300000000 AS end_us, {_NUMS}, 'USD' AS currency, 'regular' AS session FROM j WHERE mc IS NULL"),
    "normalize_c_bars": (lambda s, d: _bars(series(s, d)), _CODES + f" SELECT 'b' || l_orderkey AS raw_batch_id, l_partkey::VARCHAR AS instrument_id, '1d' AS timeframe, s AS start_us, e AS end_us, {_NUMS}, CASE WHEN (l_orderkey + l_partkey) % 3 = 0 THEN 'USD' END AS currency, 'regular' AS session FROM j WHERE sc IS NULL"),
    "normalization_issues": (
        normalization_issues,
        _CODES
        + f""", g AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
u AS (SELECT 'results' AS shape, rc AS code, l_partkey AS i FROM j WHERE rc <> 'batch' UNION ALL SELECT 'symbol_map', mc, l_orderkey FROM j WHERE mc IS NOT NULL UNION ALL SELECT 'series', sc, l_orderkey FROM j WHERE sc <> 'series'
  UNION ALL SELECT 'series', CASE WHEN l_partkey % 50 = 0 THEN 'unmapped_instrument' ELSE 'provider_response_error' END, l_orderkey FROM g WHERE l_partkey % 50 = 0 OR (l_orderkey + l_partkey) % 41 = 0 OR (l_orderkey + l_partkey) % 43 = 0
  UNION ALL SELECT 'series', 'provider_response_error', l_orderkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 10 = 0))
SELECT shape, code, {_SEV}, count(*) AS issues, count(DISTINCT i) AS batches FROM u GROUP BY shape, code""",
    ),
    "normalization_errors": (
        normalization_errors,
        "WITH p AS (SELECT DISTINCT l_partkey AS k FROM lineitem), r AS (SELECT CASE WHEN k % 50 = 0 THEN 'instrument_reference' WHEN k % 51 = 0 THEN 'status' WHEN k % 53 = 0 THEN 'adjusted_flag' WHEN k % 47 = 0 THEN 'ticker' END AS reason FROM p) SELECT reason, count(*) AS batches FROM r WHERE reason IS NOT NULL GROUP BY 1",
    ),
    "splits": (
        splits,
        _AO
        + """, n AS (SELECT *, (k % 5 + 1)::HUGEINT * 1000000000000 + CASE WHEN k % 10 = 6 THEN 1 ELSE 0 END AS a, (k % 4 + 1)::HUGEINT * 1000000000000 AS b FROM sp WHERE code IS NULL)
SELECT o_custkey::VARCHAR AS instrument_id, strftime(d, '%Y-%m-%d') AS effective_date, (a // b)::VARCHAR || '.' || lpad(((a % b * 1000000000000000000000 // b + 5) // 10)::VARCHAR, 20, '0') AS split_ratio, k::VARCHAR AS provider_record_id, 's' AS source_id FROM n""",
    ),
    "dividends": (lambda s, d: _acts(dividends_normalized(s, d)), _AO + _act("dividend", amount="o_totalprice", currency="'USD'", src="dv")),
    "ticker_changes": (lambda s, d: _acts(events_normalized(s, d)), _AO + _act("ticker_change", old="old", new="tick", key="NULL::VARCHAR", src="evr", where="true")),
    "mixed_actions": (
        lambda s, d: _acts(families_normalized(s, d)),
        _AO + " UNION ALL ".join((_act("split", _SPLIT, src="fm", where="code IS NULL AND k % 3 = 0"), _act("dividend", amount="o_totalprice", currency="'USD'", src="fm", where="code IS NULL AND k % 3 = 1"), _act("ticker_change", old="sym", new="'M' || k", src="fm", where="code IS NULL AND k % 3 = 2"))),
    ),
    "action_issues": (
        action_issues,
        _AO
        + f""", u AS (SELECT 'splits' AS kind, code FROM sp WHERE code IS NOT NULL UNION ALL SELECT 'dividends', code FROM dv WHERE code IS NOT NULL UNION ALL SELECT 'events', 'malformed_record' FROM ev WHERE NOT ok
  UNION ALL SELECT 'events', 'provider_definition' FROM evb WHERE n = 0 UNION ALL SELECT 'events', 'provider_definition' FROM evr UNION ALL SELECT 'families', code FROM fm WHERE code IS NOT NULL UNION ALL SELECT DISTINCT 'families', 'corporate_action_date_basis' FROM (SELECT o_custkey FROM o) WHERE false),
b AS (SELECT kind, code, 'batch' AS severity, count(*) AS rows FROM (SELECT DISTINCT 'splits' AS kind, 'status' AS code, o_custkey FROM o WHERE k % 3 = 0 AND o_custkey % 97 = 0 UNION ALL SELECT DISTINCT 'dividends', 'status', o_custkey FROM o WHERE k % 3 = 1 AND o_custkey % 97 = 0
  UNION ALL SELECT 'events', CASE WHEN NOT anchored THEN 'anchor' ELSE 'ambiguous_timeline' END, o_custkey FROM evb WHERE n > 0 AND (NOT anchored OR most > 1)) GROUP BY 1, 2)
SELECT kind, code, {_SEV}, count(*) AS rows FROM u GROUP BY kind, code UNION ALL SELECT * FROM b UNION ALL SELECT 'families', 'corporate_action_date_basis', 'warning', count(DISTINCT o_custkey) FROM o""",
    ),
}
