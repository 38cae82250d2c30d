"""Quality flags on bars. Rows are never dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip
from tidemark.schemas import BAR_FLAGS, DUPLICATE_KEY

# What each flag says.
MESSAGES = {
    "ohlc_inconsistent": "open, high, low and close don't fit together",
    "negative_volume": "the volume is negative",
    "duplicate_bar": "another row has the same observation key",
    "non_positive_price": "a price isn't positive",
    "unexpected_duration": "a 5m bar doesn't last five minutes",
}
REQUIRED = (*DUPLICATE_KEY, "timestamp_end", "open", "high", "low", "close", "volume", "vwap", "quality_flags")


@dataclass(frozen=True)
class ValidationPolicy:
    """duplicate_scope: `batch` looks for duplicates within a raw batch, `dataset` in the whole frame."""

    check_non_positive_prices: bool = True
    duplicate_scope: str = "dataset"


def clean_flags(flags: Column) -> Column:
    """Trimmed, without repeats, in the order given."""
    return F.array_distinct(F.transform(F.coalesce(flags, F.array().cast("array<string>")), strip))


def bad_flags(flags: Column) -> Column:
    return F.exists(F.coalesce(flags, F.array().cast("array<string>")), lambda x: x.isNull() | (strip(x) == ""))


def with_repeats(bars: DataFrame, key: tuple[str, ...], name: str) -> DataFrame:
    """bars with a boolean: has another row the same key?

    Keys are counted with map-side aggregation, and only those that repeat are joined back. They are few, so Spark broadcasts
    them where their size allows; beyond that it joins by key and splits the partitions of hot keys (adaptive skew join), which
    a window over the key could not.
    """
    repeated = bars.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key))).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n").withColumn(name, F.lit(True))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & bars[k].eqNullSafe(repeated[f"_k{i}"])
    found = bars.join(repeated, same, "left")
    return found.select(*(bars[c] for c in bars.columns), F.coalesce(name, F.lit(False)).alias(name))


def rule_masks(policy: ValidationPolicy = ValidationPolicy()) -> dict[str, Column]:
    """Each flag's condition on bars with `_repeated` (see with_repeats())."""
    o, h, low, c = (F.col(x) for x in ("open", "high", "low", "close"))
    masks = {
        "ohlc_inconsistent": (h < low) | (h < o) | (h < c) | (low > o) | (low > c),
        "negative_volume": F.col("volume") < 0,
        "duplicate_bar": F.col("_repeated"),
        "non_positive_price": (o <= 0) | (h <= 0) | (low <= 0) | (c <= 0) | F.coalesce(F.col("vwap") <= 0, F.lit(False)) if policy.check_non_positive_prices else F.lit(False),
        "unexpected_duration": (F.col("timeframe") == "5m") & (F.unix_micros("timestamp_end") - F.unix_micros("timestamp_start") != 300_000_000),
    }
    return {k: F.coalesce(masks[k], F.lit(False)) for k in BAR_FLAGS}


def validate_bars(bars: DataFrame, policy: ValidationPolicy = ValidationPolicy()) -> DataFrame:
    """All rows with quality_flags renewed: other flags first, then this module's in rule order. A null or blank flag fails the query."""
    missing = set(REQUIRED) - set(bars.columns)
    if missing:
        raise ValueError(f"missing columns {sorted(missing)}")
    managed = F.array(*(F.lit(x) for x in BAR_FLAGS))
    key = (*DUPLICATE_KEY, "raw_batch_id") if policy.duplicate_scope == "batch" else DUPLICATE_KEY
    marked = with_repeats(bars, key, "_repeated").withColumns({f"_{k}": v for k, v in rule_masks(policy).items()}).drop("_repeated")
    found = F.array_compact(F.array(*(F.when(F.col(f"_{k}"), F.lit(k)) for k in BAR_FLAGS)))
    given = F.when(bad_flags(F.col("quality_flags")), F.raise_error(F.lit("a quality flag is null or blank"))).otherwise(clean_flags(F.col("quality_flags")))
    flags = F.concat(F.array_except(given, managed), found)
    return marked.withColumn("quality_flags", flags).drop(*(f"_{k}" for k in BAR_FLAGS))


def validation_issues(validated: DataFrame) -> DataFrame:
    """One row for each managed flag of each bar, with its rule's position, severity and message."""
    text = F.create_map(*(F.lit(x) for kv in MESSAGES.items() for x in kv))
    rows = validated.select(*DUPLICATE_KEY, "raw_batch_id", F.posexplode(F.array_intersect(F.array(*(F.lit(x) for x in BAR_FLAGS)), F.col("quality_flags"))).alias("ordinal", "code"))
    return rows.withColumns({"severity": F.lit("error"), "message": text[F.col("code")]})


def flag_counts(validated: DataFrame) -> DataFrame:
    """(flag, rows) for every managed flag, zeros included, in one pass."""
    counts = validated.agg(*(F.count_if(F.array_contains("quality_flags", k)).alias(k) for k in BAR_FLAGS))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("flag"), F.col(k).alias("rows")) for k in BAR_FLAGS))).alias("x")).select("x.*")
