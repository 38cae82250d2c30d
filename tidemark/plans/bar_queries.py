"""Queries over bars: validation, coercion, storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.text import joined
from tidemark.operators import canonical, validation
from tidemark.plans import adapters
from tidemark.schemas import BAR_COLUMNS, BAR_FLAGS, DUPLICATE_KEY

_KEY = ", ".join(DUPLICATE_KEY)
LEFT = adapters.bars_sql("left")
FLAGGED = f"""
WITH v0 AS ({LEFT}),
v AS (SELECT *, count(*) OVER (PARTITION BY {_KEY}) AS same FROM v0),
flagged AS (SELECT * EXCLUDE (quality_flags), list_concat(quality_flags, [x FOR x IN [
    CASE WHEN high < low OR high < open OR high < close OR low > open OR low > close THEN 'ohlc_inconsistent' END,
    CASE WHEN volume < 0 THEN 'negative_volume' END,
    CASE WHEN same > 1 THEN 'duplicate_bar' END,
    CASE WHEN open <= 0 OR high <= 0 OR low <= 0 OR close <= 0 OR coalesce(vwap <= 0, false) THEN 'non_positive_price' END,
    CASE WHEN timeframe = '5m' AND timestamp_end - timestamp_start <> INTERVAL 5 MINUTE THEN 'unexpected_duration' END] IF x IS NOT NULL]) AS quality_flags FROM v)
"""


def validated(spark, sf_dir):
    return validation.validate_bars(adapters.bars(spark, sf_dir))


def validated_bars(spark, sf_dir):
    return validated(spark, sf_dir).select("instrument_id", "source_id", "raw_batch_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), "provider_record_id", joined(F.col("quality_flags")).alias("flags"))


def flag_counts(spark, sf_dir):
    return validation.flag_counts(validated(spark, sf_dir))


def validation_issues(spark, sf_dir):
    rows = validation.validation_issues(validated(spark, sf_dir))
    return rows.select("instrument_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), "raw_batch_id", F.col("ordinal").cast("long").alias("ordinal"), "code", "severity")


def duplicate_bars(spark, sf_dir):
    """Duplicated observation keys and how many rows share each."""
    return adapters.bars(spark, sf_dir).groupBy(*DUPLICATE_KEY).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("raw_batch_id").alias("batches")).filter("rows > 1").select("instrument_id", "source_id", "timeframe", F.unix_micros("timestamp_start").alias("start_us"), "rows", "batches")


def _spoiled(spark, sf_dir):
    """Bars with every fault that coercion rejects, some of each."""
    b = adapters.bars(spark, sf_dir)
    k = F.pmod(F.unix_seconds("timestamp_start") / 300, F.lit(101)).cast("int")
    return b.withColumns(
        {
            "high": F.when(k == 1, float("inf")).otherwise(F.col("high")),
            "open": F.when(k == 2, None).otherwise(F.col("open")),
            "quality_flags": F.when(k == 3, F.array(F.lit(" "))).otherwise(F.col("quality_flags")),
            "instrument_id": F.when(k == 4, F.lit("not-a-uuid")).when(k == 5, F.concat(F.lit("{"), F.upper("instrument_id"), F.lit("}"))).otherwise(F.col("instrument_id")),
            "timestamp_end": F.when(k == 6, F.col("timestamp_start")).otherwise(F.col("timestamp_end")),
            "ingested_at": F.when(k == 7, F.expr("retrieved_at - INTERVAL '1' SECOND")).otherwise(F.col("ingested_at")),
            "session": F.when(k == 8, F.lit("lunch")).otherwise(F.col("session")),
        }
    )


def canonical_violations(spark, sf_dir):
    return canonical.violation_counts(_spoiled(spark, sf_dir)).filter("rows > 0")


QUERIES = {
    "validated_bars": (
        validated_bars,
        FLAGGED + "SELECT instrument_id, source_id, raw_batch_id, timeframe, epoch_us(timestamp_start) AS start_us, provider_record_id, array_to_string(quality_flags, ',') AS flags FROM flagged",
    ),
    "flag_counts": (
        flag_counts,
        FLAGGED + ", f(flag) AS (VALUES " + ", ".join(f"('{x}')" for x in BAR_FLAGS) + ") SELECT flag, (SELECT count(*) FROM flagged WHERE list_contains(quality_flags, flag)) AS rows FROM f",
    ),
    "validation_issues": (
        validation_issues,
        FLAGGED
        + """, x AS (SELECT instrument_id, timeframe, epoch_us(timestamp_start) AS start_us, raw_batch_id, [c FOR c IN quality_flags IF c <> 'upstream_flag'] AS codes FROM flagged)
SELECT instrument_id, timeframe, start_us, raw_batch_id, (unnest(range(len(codes))))::BIGINT AS ordinal, unnest(codes) AS code, 'error' AS severity FROM x""",
    ),
    "duplicate_bars": (
        duplicate_bars,
        f"WITH v AS ({LEFT}) SELECT instrument_id, source_id, timeframe, epoch_us(timestamp_start) AS start_us, count(*) AS rows, count(DISTINCT raw_batch_id) AS batches FROM v GROUP BY {_KEY} HAVING count(*) > 1",
    ),
    "canonical_violations": (
        canonical_violations,
        f"""WITH v AS ({LEFT}), k AS (SELECT *, CAST(epoch_us(timestamp_start) // 300000000 AS BIGINT) % 101 AS k FROM v)
SELECT m.check_name AS check, count(*) AS rows FROM k JOIN (VALUES (1, 'not_finite_high'), (2, 'null_open'), (3, 'blank_flag'), (4, 'not_uuid_instrument_id'), (6, 'empty_interval'), (7, 'ingested_before_retrieved'), (8, 'unknown_session')) AS m(k, check_name) USING (k) GROUP BY 1""",
    ),
}
assert len(BAR_COLUMNS) == 20
