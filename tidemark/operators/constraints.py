"""Row constraints as columns of violated rules, and vocabulary maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import new_york_date
from tidemark.functions.text import finite, strip
from tidemark.schemas import FLOAT_COLUMNS

# What three wire formats call adjustments and timeframes.
ADJUSTMENT_WORDS = {"symbol_map": {"unadjusted": "raw", "split_adjusted": "split"}, "series": {"unadjusted": "none", "split_adjusted": "splits"}, "results": {"unadjusted": "false", "split_adjusted": "true"}}
TIMEFRAME_WORDS = {"symbol_map": {"1d": "1Day", "5m": "5Min"}, "series": {"1d": "1day", "5m": "5min"}, "results": {"1d": "1/day", "5m": "5/minute"}}


def wire_word(words: dict[str, dict[str, str]], shape: str, c: Column) -> Column:
    """The wire's word for a canonical one; null where the wire has none."""
    return F.create_map(*(F.lit(x) for kv in words[shape].items() for x in kv))[c]


def wire_requests(requests: DataFrame, shape: str) -> DataFrame:
    """Requests (timeframe, adjustment_state) with the words of a wire format for both, and `supported`: the wire has a word for each."""
    words = {"wire_timeframe": wire_word(TIMEFRAME_WORDS, shape, F.col("timeframe")), "wire_adjustment": wire_word(ADJUSTMENT_WORDS, shape, F.col("adjustment_state"))}
    return requests.withColumns(words).withColumn("supported", F.col("wire_timeframe").isNotNull() & F.col("wire_adjustment").isNotNull())


def broken(rules: dict[str, Column]) -> Column:
    """Names of the rules whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in rules.items())))


def bar_rules() -> dict[str, Column]:
    rules = {
        "empty_interval": F.col("timestamp_end") <= F.col("timestamp_start"),
        "ingested_before_retrieved": F.col("ingested_at") < F.col("retrieved_at"),
        "currency_not_upper": F.col("currency") != F.upper("currency"),
        "text_not_trimmed": F.col("provider_record_id") != strip(F.col("provider_record_id")),
    }
    return rules | {f"{c}_not_finite": ~finite(F.col(c)) for c in FLOAT_COLUMNS}


def upper_codes(df: DataFrame, *columns: str) -> DataFrame:
    """Currency and exchange codes in upper case, as rows are kept."""
    return df.withColumns({c: F.upper(c) for c in columns})


def action_rules() -> dict[str, Column]:
    """Rules of actions whose codes upper_codes has put in upper case."""
    kind = F.col("action_type")
    return {
        "ratio_not_positive": (kind == "split") & ~F.coalesce(F.col("split_ratio") > 0, F.lit(False)),
        "amount_not_positive": (kind == "dividend") & ~F.coalesce(F.col("amount") > 0, F.lit(False)),
        "currency_not_three_characters": (kind == "dividend") & (F.coalesce(F.char_length("currency"), F.lit(0)) != 3),
        "same_ticker": (kind == "ticker_change") & (F.lower("old_ticker") == F.lower("new_ticker")),
        "blank_ticker": (kind == "ticker_change") & (F.coalesce(strip(F.least("old_ticker", "new_ticker")), F.lit("")) == ""),
    }


def ingest_rules() -> dict[str, Column]:
    """For rows that carry retrieved_at and ingested_at."""
    return {"ingested_before_retrieved": F.col("ingested_at") < F.col("retrieved_at")}


def interval_rules() -> dict[str, Column]:
    return {"empty_validity": F.col("valid_to") <= F.col("valid_from")}


def instrument_rules() -> dict[str, Column]:
    """Codes of an instrument may be absent; where given, a currency has three characters and an exchange four."""
    return {"currency_length": F.char_length("primary_currency") != 3, "mic_length": F.char_length("mic") != 4}


def session_violations(sessions: DataFrame) -> DataFrame:
    """Sessions (session_date, start, end, source) that are empty, unnamed, off their New York date, longer than a day or repeated."""
    days = sessions.groupBy("session_date").agg(F.count(F.lit(1)).alias("_n"))
    rules = {
        "empty_session": F.col("end") <= F.col("start"),
        "blank_source": F.coalesce(strip(F.col("source")), F.lit("")) == "",
        "starts_on_another_date": new_york_date(F.col("start")) != F.col("session_date"),
        "ends_on_another_date": new_york_date(F.col("end") - F.expr("INTERVAL '1' MICROSECOND")) != F.col("session_date"),
        "longer_than_a_day": F.unix_micros("end") - F.unix_micros("start") > 86_400_000_000,
        "repeated_date": F.col("_n") > 1,
    }
    return violations(sessions.join(days, "session_date"), rules, ["session_date", "source"])


def violations(df: DataFrame, rules: dict[str, Column], key: list[str]) -> DataFrame:
    """key and rule, one row for each broken rule of each row."""
    return df.select(*key, F.explode(broken(rules)).alias("rule"))


def request_violations(requests: DataFrame) -> DataFrame:
    """Requests (request_id, start, end, instrument_id, provider_identifier; a row a reference) that are empty or repeat a member."""
    g = requests.groupBy("request_id").agg(
        F.count("instrument_id").alias("n"), F.count_distinct("instrument_id").alias("instruments"), F.count_distinct("provider_identifier").alias("identifiers"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    rules = {"empty_interval": F.col("end") <= F.col("start"), "no_instruments": F.col("n") == 0, "repeated_instrument": F.col("instruments") < F.col("n"), "repeated_identifier": F.col("identifiers") < F.col("n")}
    return violations(g, rules, ["request_id"])
