"""Fixed schemas and vocabularies of bars, corporate actions and raw pages."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and vocabularies of the data model.
TIMEFRAMES = ("1d", "5m")
SESSIONS = ("regular", "pre_market", "post_market", "overnight", "unknown")
ADJUSTMENTS = ("unadjusted", "split_adjusted", "split_and_dividend_adjusted", "provider_adjusted_unknown", "unknown")
BAR_FLAGS = ("ohlc_inconsistent", "negative_volume", "duplicate_bar", "non_positive_price", "unexpected_duration")
CLASSES = (
    "definitional_difference",
    "adjustment_difference",
    "venue_feed_difference",
    "timing_session_difference",
    "missing_observation",
    "likely_provider_issue",
    "unresolved_discrepancy",
)
NUMERIC_METRICS = ("open", "high", "low", "close", "vwap", "volume")
ACTION_TYPES = ("split", "dividend", "ticker_change")

UUID_COLUMNS = ("instrument_id", "source_id", "raw_batch_id")
FLOAT_COLUMNS = ("open", "high", "low", "close", "volume", "vwap")
NULLABLE = frozenset({"volume", "vwap", "currency", "provider_record_id", "available_at"})


def _bar_schema() -> T.StructType:
    kinds = (
        (T.StringType(), ("instrument_id", "timeframe")),
        (T.TimestampType(), ("timestamp_start", "timestamp_end")),
        (T.DoubleType(), ("open", "high", "low", "close", "volume", "vwap")),
        (T.StringType(), ("currency", "session", "adjustment_state", "source_id", "raw_batch_id", "provider_record_id")),
        (T.TimestampType(), ("available_at", "retrieved_at", "ingested_at")),
        (T.ArrayType(T.StringType(), False), ("quality_flags",)),
    )
    return T.StructType([T.StructField(n, k, n in NULLABLE) for k, names in kinds for n in names])


BAR_SCHEMA = _bar_schema()
BAR_COLUMNS = tuple(BAR_SCHEMA.names)
BAR_KEY = ("instrument_id", "timeframe", "timestamp_start")
#: A bar is a duplicate of another if these agree.
DUPLICATE_KEY = ("instrument_id", "source_id", "timeframe", "timestamp_start", "adjustment_state", "session")
ACTION_KEY = ("instrument_id", "action_type", "effective_date")
