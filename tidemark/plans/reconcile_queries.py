"""Queries that compare two providers' bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import joined
from tidemark.operators import reconcile_bars as rb
from tidemark.plans import adapters
from tidemark.schemas import BAR_KEY, CLASSES, NUMERIC_METRICS

CONFIG = rb.BarComparison("left", "right", venue_metrics=frozenset({"volume"}))
LEFT, RIGHT = adapters.bars_sql("left"), adapters.bars_sql("right")


def sides(spark, sf_dir):
    return adapters.bars(spark, sf_dir, "left"), adapters.bars(spark, sf_dir, "right")


def expected(left):
    """Keys that both sides should have: left's, and some ten minutes later that mostly nobody has."""
    starts = F.array_compact(F.array("timestamp_start", F.when(F.col("raw_batch_id").endswith("7"), F.expr("timestamp_start + INTERVAL '10' MINUTE"))))
    return left.select("instrument_id", "timeframe", F.explode(starts).alias("timestamp_start"))


def later(left):
    """Those of expected() that aren't left's own."""
    return left.filter(F.col("raw_batch_id").endswith("7")).select("instrument_id", "timeframe", F.expr("timestamp_start + INTERVAL '10' MINUTE").alias("timestamp_start"))


def findings(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return rb.compare_bars(left, right, CONFIG, later(left), wanted=F.lit(True))


def bar_findings(spark, sf_dir):
    return findings(spark, sf_dir).select(
        "instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), F.col("ordinal").cast("long").alias("ordinal"), "metric", "classification",
        "left_number", "right_number", "left_text", "right_text", joined(F.col("left_raw")).alias("left_raw"), joined(F.col("right_raw")).alias("right_raw"),
    )


def shifted_pairs(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return rb.shifted_pairs(left, right).select("instrument_id", "timeframe", F.unix_micros("left_start").alias("left_us"), F.unix_micros("right_start").alias("right_us"))


def bar_provider_metrics(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return rb.provider_metrics(left, right, later(left), ("left", "right"), wanted=F.lit(True))


def missing_expected(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return rb.missing_expected(right, expected(left)).select("instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"))


def segment_rollup(spark, sf_dir):
    """Segments here are the timeframes and years of the bars."""
    left, right = (x.withColumn("segment", F.concat_ws("-", "timeframe", F.year("timestamp_start"))) for x in sides(spark, sf_dir))
    return rb.segment_rollup(rb.compared_segments(left, right, ("left", "right"), F.col("segment").startswith("5m")))


def first_findings(spark, sf_dir):
    """The hundred findings that a report shows first, in key order and then in the order of metrics."""
    x = rb.rendered_findings(findings(spark, sf_dir)).filter("ordinal < 6").limit(100)
    return x.select("instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), F.col("ordinal").cast("long").alias("ordinal"), "metric", "left_value", "right_value")


def numeric_differences(spark, sf_dir):
    x = rb.numeric_differences(findings(spark, sf_dir))
    return x.select("metric", "findings", F.round("mean_absolute", 4).alias("mean_absolute"), "max_absolute", F.round("mean_relative", 8).alias("mean_relative"), "max_relative")


def adjustment_behavior(spark, sf_dir):
    left, right = sides(spark, sf_dir)
    return rb.adjusted_behaviour(left.filter("adjustment_state = 'unadjusted'"), right.filter("adjustment_state = 'split_adjusted'"))


def _close(m: str) -> str:
    absolute, relative = ("0.0", "1e-8") if m == "volume" else ("1e-9", "1e-8")
    return f"((l_{m} IS NULL AND r_{m} IS NULL) OR coalesce(abs(l_{m} - r_{m}) <= greatest({relative}::DOUBLE * greatest(abs(l_{m}), abs(r_{m})), {absolute}::DOUBLE), false))"


def _grouped(name: str, key: str = "instrument_id, timeframe, ts") -> str:
    row = ", ".join(f"min({c}) AS {name}_{c}" for c in ("session", "adjustment_state", "currency", *NUMERIC_METRICS))
    return f"{name}g AS (SELECT {key}, count(*) AS {name}n, list_sort(list(DISTINCT raw_batch_id)) AS {name}raw, min(timestamp_end) AS {name}_end, {row} FROM {name} GROUP BY {key})"


def _compared(extra: str = "", expected_sql: str = "SELECT instrument_id, timeframe, ts FROM e") -> str:
    k = f"{extra}instrument_id, timeframe"
    numeric = "".join(
        f"""
  UNION ALL SELECT {k}, ts, {6 + i}, '{m}', CASE WHEN adj THEN 'adjustment_difference' WHEN ses OR bound THEN 'timing_session_difference' {"WHEN true THEN 'venue_feed_difference'" if m == "volume" else ""} ELSE 'unresolved_discrepancy' END, l_{m}, r_{m}, NULL, NULL, lraw, rraw FROM one WHERE NOT {_close(m)}"""
        for i, m in enumerate(NUMERIC_METRICS)
    )
    f = "'%Y-%m-%dT%H:%M:%S+00:00'"
    return f"""
{_grouped('l', k + ', ts')}, {_grouped('r', k + ', ts')},
al AS (SELECT * FROM lg ANTI JOIN rg USING ({k}, ts) WHERE timeframe = '5m' AND ln = 1),
ar AS (SELECT * FROM rg ANTI JOIN lg USING ({k}, ts) WHERE timeframe = '5m' AND rn = 1),
cand AS (SELECT {k}, al.ts AS ts, ar.ts AS rts FROM al JOIN ar USING ({k}) WHERE al.ts <> ar.ts AND abs(epoch_us(al.ts) - epoch_us(ar.ts)) <= 60000000),
pairs AS (SELECT * FROM cand QUALIFY count(*) OVER (PARTITION BY {k}, ts) = 1 AND count(*) OVER (PARTITION BY {k}, rts) = 1),
rm AS (SELECT rg.* EXCLUDE (ts), coalesce(p.ts, rg.ts) AS ts, rg.ts AS own FROM rg LEFT JOIN (SELECT {k}, rts, ts FROM pairs) AS p ON {' AND '.join(f'rg.{c.strip()} = p.{c.strip()}' for c in k.split(','))} AND rg.ts = p.rts),
ex AS (SELECT DISTINCT * FROM ({expected_sql}) AS q ANTI JOIN (SELECT {k}, rts AS ts FROM pairs) AS p USING ({k}, ts)),
ks AS (SELECT {k}, ts FROM lg UNION SELECT {k}, ts FROM rm UNION SELECT {k}, ts FROM ex),
b AS (SELECT ks.*, lg.* EXCLUDE ({k}, ts), rm.* EXCLUDE ({k}, ts), coalesce(ln, 0) AS a, coalesce(rn, 0) AS z FROM ks LEFT JOIN lg USING ({k}, ts) LEFT JOIN rm USING ({k}, ts)),
one AS (SELECT *, ts <> own OR l_end <> r_end AS bound, l_session <> r_session AS ses, l_adjustment_state <> r_adjustment_state AS adj FROM b WHERE a = 1 AND z = 1),
found({k}, ts, ordinal, metric, classification, left_number, right_number, left_text, right_text, lraw, rraw) AS (
  SELECT {k}, ts, 0, 'duplicate_bar', 'likely_provider_issue', NULL::DOUBLE, NULL::DOUBLE, a::VARCHAR, z::VARCHAR, lraw, rraw FROM b WHERE a > 1 OR z > 1
  UNION ALL SELECT {k}, ts, 1, 'availability', 'missing_observation', NULL, NULL, a::VARCHAR, z::VARCHAR, lraw, rraw FROM b WHERE a <= 1 AND z <= 1 AND (a = 0 OR z = 0)
  UNION ALL SELECT {k}, ts, 2, 'interval_boundary', 'timing_session_difference', NULL, NULL, '[' || strftime(ts, {f}) || ', ' || strftime(l_end, {f}) || ')', '[' || strftime(own, {f}) || ', ' || strftime(r_end, {f}) || ')', lraw, rraw FROM one WHERE bound
  UNION ALL SELECT {k}, ts, 3, 'session', 'timing_session_difference', NULL, NULL, l_session, r_session, lraw, rraw FROM one WHERE ses
  UNION ALL SELECT {k}, ts, 4, 'adjustment', 'adjustment_difference', NULL, NULL, l_adjustment_state, r_adjustment_state, lraw, rraw FROM one WHERE adj
  UNION ALL SELECT {k}, ts, 5, 'currency', 'definitional_difference', NULL, NULL, l_currency, r_currency, lraw, rraw FROM one WHERE l_currency IS DISTINCT FROM r_currency{numeric})
"""


BASE = f"WITH l AS (SELECT *, timestamp_start AS ts FROM ({LEFT})), r AS (SELECT *, timestamp_start AS ts FROM ({RIGHT})), e AS (SELECT instrument_id, timeframe, ts FROM l UNION SELECT instrument_id, timeframe, ts + INTERVAL 10 MINUTE FROM l WHERE raw_batch_id LIKE '%7'),"
FOUND = BASE + _compared()


def _missing(side: str) -> str:
    return f"""absent_{side} AS (SELECT * FROM e ANTI JOIN {side}g USING (instrument_id, timeframe, ts)),
spare_{side} AS (SELECT instrument_id, timeframe, ts FROM {side}g ANTI JOIN e USING (instrument_id, timeframe, ts)),
near_{side} AS (SELECT m.instrument_id, m.timeframe, m.ts, s.ts AS sts FROM absent_{side} m JOIN spare_{side} s ON m.instrument_id = s.instrument_id AND m.timeframe = s.timeframe AND m.timeframe = '5m' AND m.ts <> s.ts AND abs(epoch_us(m.ts) - epoch_us(s.ts)) <= 60000000),
met_{side} AS (SELECT * FROM near_{side} QUALIFY count(*) OVER (PARTITION BY instrument_id, timeframe, ts) = 1 AND count(*) OVER (PARTITION BY instrument_id, timeframe, sts) = 1),
missing_{side} AS (SELECT * FROM absent_{side} ANTI JOIN met_{side} USING (instrument_id, timeframe, ts))"""


#: Each side is read once, and near keys meet by minute.
MISSING = f"""
WITH l AS MATERIALIZED (SELECT instrument_id, timeframe, timestamp_start AS ts, raw_batch_id FROM ({LEFT})), r AS MATERIALIZED (SELECT instrument_id, timeframe, timestamp_start AS ts FROM ({RIGHT})),
k AS MATERIALIZED (
  SELECT instrument_id, timeframe, ts, max(wanted) AS wanted, max(1 - wanted) AS seen
  FROM (SELECT instrument_id, timeframe, ts, 1 AS wanted FROM l UNION ALL SELECT instrument_id, timeframe, ts + INTERVAL 10 MINUTE, 1 FROM l WHERE raw_batch_id LIKE '%7' UNION ALL SELECT instrument_id, timeframe, ts, 0 FROM r) GROUP BY 1, 2, 3),
m AS (SELECT *, epoch_us(ts) // 60000000 AS minute FROM k WHERE wanted = 1 AND seen = 0),
s AS (SELECT instrument_id, timeframe, ts AS sts, unnest([epoch_us(ts) // 60000000 - 1, epoch_us(ts) // 60000000, epoch_us(ts) // 60000000 + 1]) AS minute FROM k WHERE wanted = 0 AND seen = 1 AND timeframe = '5m'),
near AS (SELECT m.instrument_id, m.timeframe, ts, sts FROM m JOIN s USING (instrument_id, timeframe, minute) WHERE abs(epoch_us(ts) - epoch_us(sts)) <= 60000000),
met AS (SELECT * FROM near QUALIFY count(*) OVER (PARTITION BY instrument_id, timeframe, ts) = 1 AND count(*) OVER (PARTITION BY instrument_id, timeframe, sts) = 1)
SELECT instrument_id, timeframe, epoch_us(ts) AS start_us FROM m ANTI JOIN met USING (instrument_id, timeframe, ts)"""

_NUM = "open, high, low, close, volume"
QUERIES = {
    "bar_findings": (
        bar_findings,
        FOUND + "SELECT instrument_id, timeframe, epoch_us(ts) AS start_us, ordinal::BIGINT AS ordinal, metric, classification, left_number, right_number, left_text, right_text, coalesce(array_to_string(lraw, ','), '') AS left_raw, coalesce(array_to_string(rraw, ','), '') AS right_raw FROM found",
    ),
    "finding_counts_by_class": (
        lambda spark, d: rb.counts_by_class(findings(spark, d)),
        FOUND + ", c(classification) AS (VALUES " + ", ".join(f"('{c}')" for c in CLASSES) + ") SELECT classification, count(metric) AS findings FROM c LEFT JOIN found USING (classification) GROUP BY 1",
    ),
    "finding_counts_by_metric": (lambda spark, d: rb.counts_by_metric(findings(spark, d)), FOUND + "SELECT metric, count(*) AS findings FROM found GROUP BY 1"),
    "sanitized_findings": (lambda spark, d: rb.sanitized(findings(spark, d)), FOUND + "SELECT metric, classification, count(*) AS findings FROM found GROUP BY 1, 2"),
    "numeric_differences": (
        numeric_differences,
        FOUND
        + """, d AS (SELECT metric, abs(left_number - right_number) AS g, abs(left_number - right_number) / nullif(greatest(abs(left_number), abs(right_number)), 0) AS s FROM found WHERE left_number IS NOT NULL AND right_number IS NOT NULL)
SELECT metric, count(*) AS findings, round(avg(g), 4) AS mean_absolute, max(g) AS max_absolute, round(avg(s), 8) AS mean_relative, max(s) AS max_relative FROM d GROUP BY 1""",
    ),
    "shifted_pairs": (shifted_pairs, FOUND + "SELECT instrument_id, timeframe, epoch_us(ts) AS left_us, epoch_us(rts) AS right_us FROM pairs"),
    "missing_expected": (missing_expected, MISSING),
    "bar_provider_metrics": (
        bar_provider_metrics,
        f"{BASE} {_grouped('l')}, {_grouped('r')}, {_missing('l')}, {_missing('r')} "
        + " UNION ALL ".join(
            f"SELECT '{n}' AS provider, (SELECT sum({s}n) FROM {s}g)::BIGINT AS observations, (SELECT count(*) FROM {s}g) AS unique_keys, (SELECT sum({s}n - 1) FROM {s}g)::BIGINT AS duplicates, (SELECT count(*) FROM e) AS expected, (SELECT count(*) FROM missing_{s}) AS missing" for n, s in (("left", "l"), ("right", "r"))
        ),
    ),
    "segment_rollup": (
        segment_rollup,
        f"WITH l AS (SELECT *, timestamp_start AS ts, timeframe || '-' || year(timestamp_start) AS segment FROM ({LEFT})), r AS (SELECT *, timestamp_start AS ts, timeframe || '-' || year(timestamp_start) AS segment FROM ({RIGHT})),"
        + _compared("segment, ", "SELECT segment, instrument_id, timeframe, ts FROM l WHERE false")
        + """, x AS (SELECT segment, count(*) AS left_rows FROM l GROUP BY 1), y AS (SELECT segment, count(*) AS right_rows FROM r GROUP BY 1), z AS (SELECT segment, count(*) AS findings, count(*) FILTER (metric = 'duplicate_bar') AS duplicates, count(*) FILTER (classification = 'venue_feed_difference' AND segment LIKE '5m%') AS venue FROM found WHERE metric <> 'vwap' GROUP BY 1)
SELECT segment, coalesce(left_rows, 0) AS left_rows, coalesce(right_rows, 0) AS right_rows, coalesce(findings, 0) AS findings, coalesce(duplicates, 0) AS duplicates, coalesce(venue, 0) AS venue, coalesce(left_rows, 0) > 0 AND coalesce(right_rows, 0) > 0 AND coalesce(duplicates, 0) = 0 AS passed FROM x FULL JOIN y USING (segment) FULL JOIN z USING (segment)""",
    ),
    "first_findings": (
        first_findings,
        FOUND + "SELECT instrument_id, timeframe, epoch_us(ts) AS start_us, ordinal::BIGINT AS ordinal, metric, left_text AS left_value, right_text AS right_value FROM found WHERE ordinal < 6 ORDER BY instrument_id, timeframe, ts, ordinal LIMIT 100",
    ),
    "adjustment_behavior": (
        adjustment_behavior,
        f"""WITH p AS (SELECT * FROM ({LEFT}) WHERE adjustment_state = 'unadjusted' QUALIFY row_number() OVER (PARTITION BY instrument_id, timestamp_start ORDER BY raw_batch_id DESC, open DESC, high DESC, low DESC, close DESC, volume DESC NULLS LAST) = 1),
a AS (SELECT * FROM ({RIGHT}) WHERE adjustment_state = 'split_adjusted' QUALIFY row_number() OVER (PARTITION BY instrument_id, timestamp_start ORDER BY raw_batch_id DESC, open DESC, high DESC, low DESC, close DESC, volume DESC NULLS LAST) = 1)
SELECT count(*) AS matched, count(*) FILTER (p.open IS DISTINCT FROM a.open OR p.high IS DISTINCT FROM a.high OR p.low IS DISTINCT FROM a.low OR p.close IS DISTINCT FROM a.close OR p.volume IS DISTINCT FROM a.volume) AS different
FROM p JOIN a USING (instrument_id, timestamp_start)""",
    ),
}
