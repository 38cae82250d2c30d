"""Bars, actions and logs derived from the sample tables by SQL text that two engines read alike.

The text of an adapter is shared with the SQL that checks the queries, so adapters hold no operator: only column
expressions, a few seeded faults by remainders of keys, and the few functions whose names differ are filled in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK = {"EMPTY": "CAST(array() AS array<string>)", "UPSTREAM": "array('upstream_flag')"}
_OTHER = {"EMPTY": "CAST([] AS VARCHAR[])", "UPSTREAM": "['upstream_flag']"}


def _uuid(expression: str, kind: int) -> str:
    return f"concat('00000000-0000-4000-8{kind:03d}-', lpad(CAST({expression} AS STRING), 12, '0'))"


_BASE = f"""
  SELECT l.*, l_orderkey * 8 + l_linenumber AS n, CASE WHEN l_linenumber % 3 = 0 THEN '1d' ELSE '5m' END AS tf,
    CAST(l_shipdate AS TIMESTAMP) + (INTERVAL '5' MINUTE) * (162 + CASE WHEN l_linenumber % 3 = 0 THEN 0 ELSE l_orderkey % 78 END) AS t0,
    l_extendedprice / l_quantity AS p, {{COPY}} AS copy
  FROM lineitem l"""

_BARS = f"""
SELECT {_uuid('l_partkey', 1)} AS instrument_id, tf AS timeframe, {{START}} AS timestamp_start,
  CASE WHEN tf = '1d' THEN {{START}} + INTERVAL '390' MINUTE WHEN n % 67 = 0 THEN {{START}} + INTERVAL '4' MINUTE ELSE {{START}} + INTERVAL '5' MINUTE END AS timestamp_end,
  CASE WHEN n % 71 = 0 THEN 0 - p ELSE p END AS open, CASE WHEN n % 37 = 0 THEN p * (1 - l_tax) - 1 ELSE p * (1 + l_tax) END AS high,
  p * (1 - l_discount) AS low, {{CLOSE}} AS close,
  CASE WHEN n % 59 = 0 THEN NULL WHEN n % 53 = 0 THEN 0 - l_quantity ELSE l_quantity + {{VOLUME}} END AS volume,
  CASE WHEN l_linenumber = 4 THEN NULL WHEN n % 61 = 0 THEN CAST(0 AS DOUBLE) ELSE p END AS vwap,
  CASE WHEN n % 29 = {{CURRENCY}} THEN NULL ELSE 'USD' END AS currency,
  CASE WHEN n % 19 = {{SESSION}} THEN 'unknown' ELSE 'regular' END AS session,
  CASE WHEN n % 23 = {{ADJUSTED}} THEN 'split_adjusted' ELSE 'unadjusted' END AS adjustment_state,
  {_uuid('l_suppkey % 4', 2)} AS source_id, {_uuid('(l_orderkey + copy) % 1000', 3)} AS raw_batch_id,
  CASE WHEN n % 3 = 0 THEN NULL ELSE CAST(n AS STRING) END AS provider_record_id,
  CASE WHEN n % 2 = 0 THEN NULL ELSE {{START}} + INTERVAL '1' DAY END AS available_at,
  {{START}} + INTERVAL '1' DAY AS retrieved_at, {{START}} + INTERVAL '1441' MINUTE AS ingested_at,
  CASE WHEN n % 31 = 0 THEN {{UPSTREAM}} ELSE {{EMPTY}} END AS quality_flags
FROM b"""

_LEFT = {"START": "t0", "CLOSE": "p * (1 + l_tax - l_discount)", "VOLUME": "0", "CURRENCY": "-1", "SESSION": "-1", "ADJUSTED": "-1"}
_RIGHT = {
    "START": "(t0 + (INTERVAL '1' SECOND) * (CASE WHEN tf = '5m' AND n % 13 = 0 THEN 60 WHEN tf = '5m' AND n % 13 = 1 THEN -30 WHEN tf = '5m' AND n % 13 = 2 THEN 120 ELSE 0 END))",
    "CLOSE": "p * (1 + l_tax - l_discount) * CASE WHEN n % 7 = 0 THEN 1.001 ELSE 1 END",
    "VOLUME": "CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END",
    "CURRENCY": "0",
    "SESSION": "0",
    "ADJUSTED": "0",
}


def _fill(text: str, values: dict[str, str]) -> str:
    for k, v in values.items():
        text = text.replace("{" + k + "}", v)
    return text


def bars_sql(side: str, dialect: dict[str, str] = _OTHER) -> str:
    """left: one bar a lineitem and every 41st twice. right: the same with gaps, repeats, shifts and changed values."""
    again = 41 if side == "left" else 17
    keep = "" if side == "left" else " WHERE n % 11 <> 0"
    base = _fill(_BASE, {"COPY": "0"}) + " UNION ALL " + _fill(_BASE, {"COPY": "1"}) + f" WHERE (l_orderkey * 8 + l_linenumber) % {again} = 0"
    return f"WITH b AS (SELECT * FROM ({base}) AS u{keep}) " + _fill(_BARS, (_LEFT if side == "left" else _RIGHT) | dialect)


_ACTIONS = f"""
SELECT {_uuid('o_custkey', 1)} AS instrument_id, CASE WHEN o_orderkey % 3 = 0 THEN 'split' WHEN o_orderkey % 3 = 1 THEN 'dividend' ELSE 'ticker_change' END AS action_type,
  {{DAY}} AS effective_date,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 5 + 2 + {{RATIO}} AS DECIMAL(18, 8)) END AS split_ratio,
  CASE WHEN o_orderkey % 3 = 1 THEN CAST(CAST(o_totalprice AS DECIMAL(12, 2)) + {{AMOUNT}} AS DECIMAL(18, 8)) END AS amount,
  CASE WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_orderkey % 31 = {{CURRENCY}} THEN 'EUR' ELSE 'USD' END END AS currency,
  CASE WHEN o_orderkey % 3 = 2 THEN concat('T', CAST(o_custkey AS STRING)) END AS old_ticker,
  CASE WHEN o_orderkey % 3 = 2 THEN concat('N', CAST(o_custkey + {{TICKER}} AS STRING)) END AS new_ticker,
  {_uuid('o_custkey % 4', 2)} AS source_id, {_uuid('o_orderkey % 100', 3)} AS raw_batch_id
FROM (SELECT o.*, {{COPY}} AS copy FROM orders o UNION ALL SELECT o.*, 1 AS copy FROM orders o WHERE o_orderkey % {{AGAIN}} = 0) AS o{{KEEP}}"""


def actions_sql(side: str) -> str:
    day = "CAST(o_orderdate AS DATE)"
    if side == "left":
        return _fill(_ACTIONS, {"DAY": day, "RATIO": "0", "AMOUNT": "0", "CURRENCY": "-1", "TICKER": "0", "AGAIN": "97", "COPY": "0", "KEEP": ""})
    shifted = f"CAST({day} + (INTERVAL '1' DAY) * (CASE WHEN o_orderkey % 7 = 0 THEN 3 WHEN o_orderkey % 7 = 1 THEN -9 ELSE 0 END) AS DATE)"
    return _fill(
        _ACTIONS,
        {"DAY": shifted, "RATIO": "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END", "AMOUNT": "CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END", "CURRENCY": "0", "TICKER": "CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END", "AGAIN": "89", "COPY": "0", "KEEP": " WHERE o_orderkey % 13 <> 0"},
    )


def _view(spark: SparkSession, sf_dir: str, table: str, sql: str) -> DataFrame:
    """The SQL over one table given as a parameter, so that no view of that name is made or replaced."""
    return spark.sql(sql.replace(f"FROM {table} ", "FROM {" + table + "} "), **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def bars(spark: SparkSession, sf_dir: str, side: str = "left") -> DataFrame:
    return _view(spark, sf_dir, "lineitem", bars_sql(side, _SPARK).replace("FROM lineitem l", "FROM lineitem l "))


def actions(spark: SparkSession, sf_dir: str, side: str = "left") -> DataFrame:
    return _view(spark, sf_dir, "orders", actions_sql(side))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
