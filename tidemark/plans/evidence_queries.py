"""Queries over evidence from raw pages, actions by endpoint and source, multisets of bars, wire words and what leaves a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import canonical, constraints, metrics
from tidemark.operators import reconcile_actions as ra
from tidemark.operators.reference_data import source_dimension
from tidemark.plans import adapters
from tidemark.plans import normalize_queries as nq
from tidemark.plans.action_queries import CALENDAR, _calendar
from tidemark.plans.adapters import table
from tidemark.plans.raw_queries import NAMESPACE
from tidemark.sources import normalize as nz
from tidemark.sources.files import scratch_folder


def _listed(counts):
    return F.array_join(F.transform(F.map_entries(counts), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")


def _evidence_pages(spark, sf_dir):
    """Three series of a part in two pages each, in the shapes of two providers. The prices of every seventh part double when adjusted."""
    text = lambda c: F.col(c).cast("string")
    factor = F.when(F.col("l_partkey") % 7 == 0, 2).otherwise(1)
    x = nq._lines(spark, sf_dir, "l_partkey")
    short = F.struct(F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("t"), F.col("p").alias("o"), F.col("high").alias("h"), F.col("p").alias("l"), F.col("close").alias("c"))
    long = F.struct(F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("datetime"), text("p").alias("open"), text("high").alias("high"), text("p").alias("low"), text("close").alias("close"))
    twice = F.struct(F.date_format("at", "yyyy-MM-dd").alias("datetime"), *((F.col(c) * factor).cast("string").alias(n) for c, n in (("p", "open"), ("high", "high"), ("p", "low"), ("close", "close"))))
    in_order = lambda rec: F.transform(F.array_sort(F.collect_list(F.struct("n", rec.alias("r")))), lambda e: e["r"])
    per = x.groupBy("l_partkey", "symbol", (F.col("n") % 2 + 1).cast("int").alias("page_number")).agg(in_order(short).alias("short"), in_order(long).alias("long"), in_order(twice).alias("twice"))
    under = lambda value: F.map_from_arrays(F.array("symbol"), F.array(value))
    bodies = (
        ("first", "unadjusted", F.to_json(F.struct(under(F.col("short")).alias("bars")))),
        ("second", "unadjusted", F.to_json(F.struct(F.col("long").alias("values")))),
        ("second", "split_adjusted", F.to_json(under(F.struct(F.col("twice").alias("values"))))),
    )
    pages = F.array(*(F.struct(F.lit(p).alias("provider"), F.lit(a).alias("adjustment"), F.encode(body, "UTF-8").alias("payload")) for p, a, body in bodies))
    return per.select("l_partkey", "symbol", "page_number", F.explode(pages).alias("x")).select("l_partkey", "symbol", "page_number", "x.*")


def page_evidence(spark, sf_dir):
    """Daily prices straight from raw pages, against the first provider's. Lines are dealt by part once, and all that follows stays with them."""
    found = metrics.evidence_series(_evidence_pages(spark, sf_dir), ["provider", "adjustment", "l_partkey"])
    return metrics.compared_with(found, F.col("provider") == "first", ["provider", "adjustment"], ["l_partkey", "day"])


def _sources(spark, sf_dir):
    """A source for each action endpoint of each region."""
    endpoint = F.explode(F.array(*map(F.lit, nz.ACTION_ENDPOINTS)))
    listing = table(spark, sf_dir, "region").select(F.lower("r_name").alias("provider"), F.lit("corporate_actions").alias("dataset"), endpoint.alias("endpoint"))
    return source_dimension(listing.withColumn("name", F.concat_ws(":", "provider", "endpoint")), NAMESPACE)


def actions_by_endpoint(spark, sf_dir):
    """Actions of pages from the sources of their customers' regions; some pages have an endpoint without a normalizer, some another endpoint's source."""
    k = F.col("instrument_id").cast("long")
    parts = {"splits": nq.splits_pages, "dividends": nq.dividends_pages, "ticker_events": nq.events_pages}
    pages = reduce(lambda a, b: a.unionByName(b), (f(spark, sf_dir).withColumn("endpoint", F.lit(e)) for e, f in parts.items()))
    regions = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    homes = table(spark, sf_dir, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("instrument_id"), F.lower("r_name").alias("provider"))
    sources = _sources(spark, sf_dir)
    sent = F.when(k % 89 == 0, "news").otherwise(F.col("endpoint"))
    pages = pages.drop("source_id").join(homes, "instrument_id").withColumn("name", F.concat_ws(":", "provider", sent))
    pages = pages.join(sources.select("name", "source_id"), "name", "left").withColumn("endpoint", F.when(k % 83 == 0, "mergers").otherwise(F.col("endpoint"))).drop("name", "provider")
    found = nz.normalize_by_endpoint(pages, sources.select("endpoint", "source_id"))
    rows = found.rows.groupBy(F.col("action_type").alias("code")).agg(F.count(F.lit(1)).alias("rows")).withColumn("what", F.lit("action"))
    return rows.unionByName(found.batch_errors.groupBy(F.col("reason").alias("code")).agg(F.count(F.lit(1)).alias("rows")).withColumn("what", F.lit("error")))


def sources(spark, sf_dir):
    return _sources(spark, sf_dir).select("source_id", "name", "provider", "dataset", "endpoint")


def action_page_summary(spark, sf_dir):
    """Pages, actions and issues of the families' pages by the last digit of their customer; the batch's id stands for its page."""
    pages, refs = nq.families_pages(spark, sf_dir)
    found = nz.normalize_families(pages, refs)
    k = F.regexp_replace("raw_batch_id", "c", "").cast("long")
    own = lambda df: df.withColumn("provider", (k % 10).cast("string"))
    latency = F.create_map(F.lit("latency_ms"), F.when(k % 10 == 3, "fast").otherwise((k % 500).cast("string")))
    told = own(pages.select("raw_batch_id", F.encode("raw_batch_id", "UTF-8").alias("payload"))).withColumn("request_metadata", latency)
    x = metrics.action_summary(told, own(found.rows), own(found.issues))
    return x.select("provider", "pages", "bytes", F.col("latency_max").cast("long").alias("latency_max"), "actions", _listed(F.col("type_counts")).alias("type_counts"), _listed(F.col("issue_counts")).alias("issue_counts"))


def frame_differences(spark, sf_dir):
    """Bars that one side holds more often than the other, all columns compared."""
    x = canonical.frame_differences(adapters.bars(spark, sf_dir, "left"), adapters.bars(spark, sf_dir, "right"), shown=("timeframe", "session"))
    side = F.when(F.col("surplus") > 0, "left").otherwise("right")
    return x.groupBy("timeframe", "session", side.alias("side")).agg(F.count(F.lit(1)).alias("bars"), F.sum(F.abs("surplus")).alias("surplus"))


def overlapping_keys(spark, sf_dir):
    """Keys that several windows of a segment expect: each order opens thirty days of daily bars of its customer."""
    o = table(spark, sf_dir, "orders")
    start = F.to_date("o_orderdate")
    windows = o.select(F.lit("orders").alias("segment"), F.col("o_custkey").alias("instrument_id"), F.lit("1d").alias("timeframe"), start.cast("timestamp").alias("start"), F.date_add(start, 30).cast("timestamp").alias("end"))
    x = clock.overlapping_keys(clock.expected_keys(windows, _calendar(spark, sf_dir)))
    return x.select("segment", "instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), F.col("count").alias("windows"))


def wire_requests(spark, sf_dir):
    """What three wire formats call the timeframe and adjustment of each bar, and whether they can ask for it."""
    bars = adapters.bars(spark, sf_dir, "right").withColumn("adjustment_state", F.when(F.col("session") == "unknown", "provider_adjusted_unknown").otherwise(F.col("adjustment_state")))
    asked = bars.groupBy("timeframe", "adjustment_state").agg(F.count(F.lit(1)).alias("bars"))
    return reduce(lambda a, b: a.unionByName(b), (constraints.wire_requests(asked, s).withColumn("shape", F.lit(s)) for s in constraints.ADJUSTMENT_WORDS))


def written_results(spark, sf_dir):
    """Aggregates written as a run leaves them, read back: rows and total of each table."""
    root = scratch_folder(spark, "results")
    bars = adapters.bars(spark, sf_dir)
    by_year = bars.groupBy("timeframe", F.year("timestamp_start").alias("year")).agg(F.count(F.lit(1)).alias("rows"))
    actions = ra.action_counts(adapters.actions(spark, sf_dir)).select("action_type", F.col("actions").alias("rows"))
    metrics.write_results({"bars": by_year, "actions": actions}, root)
    read = lambda n: spark.read.parquet(f"{root}/{n}").agg(F.count(F.lit(1)).alias("rows"), F.sum("rows").alias("total")).withColumn("name", F.lit(n))
    return read("bars").unionByName(read("actions"))


_REGION = "(SELECT c_custkey, lower(r_name) AS provider FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
_GOOD = "o_custkey % 83 <> 0 AND o_custkey % 89 <> 0"
_WORDS = "(VALUES ('symbol_map', '1Day', '5Min', 'raw', 'split'), ('series', '1day', '5min', 'none', 'splits'), ('results', '1/day', '5/minute', 'false', 'true')) AS v(shape, daily, five, plain, split)"
_ID = "substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(d, 18, 3) || '-' || substr(d, 21, 12)"
QUERIES = {
    "page_evidence": (
        page_evidence,
        """WITH r AS (SELECT l_partkey, max(1) AS one FROM lineitem WHERE (l_orderkey * 8 + l_linenumber) % 37 <> 0 GROUP BY l_partkey, CAST(l_shipdate AS DATE))
SELECT provider, adjustment, count(*) AS compared, count(*) FILTER (adjustment = 'split_adjusted' AND l_partkey % 7 = 0) AS different
FROM r, (VALUES ('first', 'unadjusted'), ('second', 'unadjusted'), ('second', 'split_adjusted')) AS v(provider, adjustment) GROUP BY 1, 2""",
    ),
    "sources": (
        sources,
        f"""WITH s AS (SELECT lower(r_name) AS provider, endpoint, lower(r_name) || ':' || endpoint AS name FROM region, (VALUES ('splits'), ('dividends'), ('ticker_events')) AS v(endpoint)),
h AS (SELECT *, sha1(unhex('{NAMESPACE.replace('-', '')}') || encode(name)) AS d FROM s) SELECT {_ID} AS source_id, name, provider, 'corporate_actions' AS dataset, endpoint FROM h""",
    ),
    "actions_by_endpoint": (
        actions_by_endpoint,
        nq._AO
        + f""", u AS (SELECT 'action' AS what, 'split' AS code FROM sp WHERE code IS NULL AND {_GOOD} UNION ALL SELECT 'action', 'dividend' FROM dv WHERE code IS NULL AND {_GOOD} UNION ALL SELECT 'action', 'ticker_change' FROM evr WHERE {_GOOD}
  UNION ALL SELECT 'error', CASE WHEN o_custkey % 83 = 0 THEN 'endpoint' WHEN o_custkey % 89 = 0 THEN 'source' WHEN kind < 2 AND o_custkey % 97 = 0 THEN 'status' WHEN kind = 2 AND n > 0 AND NOT anchored THEN 'anchor' WHEN kind = 2 AND n > 0 AND most > 1 THEN 'ambiguous_timeline' END
    FROM (SELECT DISTINCT o_custkey, k % 3 AS kind FROM o) LEFT JOIN evb USING (o_custkey))
SELECT what, code, count(*) AS rows FROM u WHERE code IS NOT NULL GROUP BY 1, 2""",
    ),
    "action_page_summary": (
        action_page_summary,
        nq._AO
        + """, p AS (SELECT (c % 10)::VARCHAR AS provider, count(*) AS pages, sum(length('c' || c))::BIGINT AS bytes, max(c % 500) FILTER (c % 10 <> 3) AS latency_max FROM (SELECT DISTINCT o_custkey AS c FROM o) GROUP BY 1),
a AS (SELECT (o_custkey % 10)::VARCHAR AS provider, CASE k % 3 WHEN 0 THEN 'split' WHEN 1 THEN 'dividend' ELSE 'ticker_change' END AS code, count(*) AS n FROM fm WHERE code IS NULL GROUP BY 1, 2),
i AS (SELECT (o_custkey % 10)::VARCHAR AS provider, code, count(*) AS n FROM fm WHERE code IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT provider, 'corporate_action_date_basis', pages FROM p)
SELECT provider, pages, bytes, latency_max, coalesce(x.actions, 0) AS actions, x.type_counts, y.issue_counts FROM p
LEFT JOIN (SELECT provider, sum(n)::BIGINT AS actions, string_agg(code || '=' || n, ',' ORDER BY code) AS type_counts FROM a GROUP BY 1) AS x USING (provider)
LEFT JOIN (SELECT provider, string_agg(code || '=' || n, ',' ORDER BY code) AS issue_counts FROM i GROUP BY 1) AS y USING (provider)""",
    ),
    "frame_differences": (
        frame_differences,
        f"""WITH l AS ({adapters.bars_sql('left')}), r AS ({adapters.bars_sql('right')}), x AS (SELECT 'left' AS side, * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION ALL SELECT 'right', * FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)),
g AS (SELECT side, COLUMNS(* EXCLUDE (side)), count(*) AS n FROM x GROUP BY ALL)
SELECT timeframe, session, side, count(*) AS bars, sum(n)::BIGINT AS surplus FROM g GROUP BY 1, 2, 3""",
    ),
    "overlapping_keys": (
        overlapping_keys,
        CALENDAR
        + """, w AS (SELECT o_custkey, epoch_us(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS a, epoch_us(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY) AS b FROM orders)
SELECT 'orders' AS segment, o_custkey AS instrument_id, '1d' AS timeframe, s AS start_us, count(*) AS windows FROM w JOIN cal ON a <= s AND s < b AND e <= b GROUP BY o_custkey, s HAVING count(*) > 1""",
    ),
    "wire_requests": (
        wire_requests,
        f"""WITH b AS (SELECT timeframe, CASE WHEN session = 'unknown' THEN 'provider_adjusted_unknown' ELSE adjustment_state END AS adjustment_state, count(*) AS bars FROM ({adapters.bars_sql('right')}) GROUP BY 1, 2)
SELECT timeframe, adjustment_state, bars, shape, CASE timeframe WHEN '1d' THEN daily ELSE five END AS wire_timeframe, CASE adjustment_state WHEN 'unadjusted' THEN plain WHEN 'split_adjusted' THEN split END AS wire_adjustment, adjustment_state IN ('unadjusted', 'split_adjusted') AS supported FROM b, {_WORDS}""",
    ),
    "written_results": (
        written_results,
        f"""SELECT 'bars' AS name, count(*) AS rows, sum(n)::BIGINT AS total FROM (SELECT timeframe, year(timestamp_start), count(*) AS n FROM ({adapters.bars_sql('left')}) GROUP BY 1, 2)
UNION ALL SELECT 'actions', count(*), sum(n)::BIGINT FROM (SELECT action_type, count(*) AS n FROM ({adapters.actions_sql('left')}) GROUP BY 1)""",
    ),
}
