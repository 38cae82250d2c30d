"""Comparison of two providers' corporate actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.matching import with_partners
from tidemark.schemas import ACTION_KEY

_ROW = ("split_ratio", "amount", "currency", "old_ticker", "new_ticker")
METRIC_ORDER = ("duplicate_action", "availability", "effective_date", "split_ratio", "dividend_amount", "currency", "old_ticker", "new_ticker")


def keyed_actions(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row a key of either side, from one shuffle: ln and rn count rows, lraw and rraw are the distinct raw batches sorted, l and r a row."""
    every = left.select(*ACTION_KEY, F.lit("l").alias("_side"), "raw_batch_id", F.struct(*_ROW).alias("_row")).unionByName(right.select(*ACTION_KEY, F.lit("r").alias("_side"), "raw_batch_id", F.struct(*_ROW).alias("_row")))
    found = []
    for n in "lr":
        own = F.col("_side") == n
        found += [F.count_if(own).alias(f"{n}n"), F.array_sort(F.collect_set(F.when(own, F.col("raw_batch_id")))).alias(f"{n}raw"), F.min(F.when(own, F.col("_row"))).alias(n)]
    return every.groupBy(*ACTION_KEY).agg(*found)


def _aligned(keyed: DataFrame, days: int) -> DataFrame:
    """Keyed actions where a single one of the right side only, at most `days` apart, has moved to its partner's date on the left."""
    left, right = (F.col("ln") == 1) & (F.col("rn") == 0), (F.col("rn") == 1) & (F.col("ln") == 0)
    own = F.struct(F.col("effective_date").alias("own_date"), "rn", "rraw", "r")
    x = with_partners(keyed, ["instrument_id", "action_type"], F.unix_date("effective_date"), days, {"_shift": (left, right)}, own)
    at = F.col("_shift_partner")
    moved = {"own_date": F.when(at.isNotNull(), at.own_date).when(F.col("rn") > 0, F.col("effective_date"))} | {c: F.when(at.isNotNull(), at[c]).otherwise(F.col(c)) for c in ("rn", "rraw", "r")}
    return x.filter(~(F.col("_shift") & right)).withColumns(moved).drop("_shift_partner")


def aligned_actions(left: DataFrame, right: DataFrame, days: int) -> DataFrame:
    """Pairs of single unmatched actions of one instrument and type at most `days` apart: keys, left_date, right_date."""
    return _aligned(keyed_actions(left, right), days).filter("_shift").select("instrument_id", "action_type", F.col("effective_date").alias("left_date"), F.col("own_date").alias("right_date"))


def compare_actions(left: DataFrame, right: DataFrame, days: int = 7) -> DataFrame:
    """Findings over actions: key, ordinal, metric, classification, both values as text, raw batches of both sides. Values compare exactly."""
    if not 0 <= days <= 7:
        raise ValueError("dates may be aligned over seven days at most")
    keys = list(ACTION_KEY)
    both = _aligned(keyed_actions(left, right), days)

    def finding(metric: str, kind: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(METRIC_ORDER.index(metric)).alias("ordinal"), F.lit(metric).alias("metric"), F.lit(kind).alias("classification"), a.cast("string").alias("left_text"), b.cast("string").alias("right_text"))

    several = (F.col("ln") > 1) | (F.col("rn") > 1)
    one = (F.col("ln") == 1) & (F.col("rn") == 1)
    kind = F.col("action_type")

    def differs(c: str) -> Column:
        return ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))

    found = [
        F.when(several, finding("duplicate_action", "likely_provider_issue", F.col("ln"), F.col("rn"))),
        F.when(~several & ~one, finding("availability", "missing_observation", F.col("ln"), F.col("rn"))),
        F.when(one & (F.col("effective_date") != F.col("own_date")), finding("effective_date", "unresolved_discrepancy", F.col("effective_date"), F.col("own_date"))),
        *(
            F.when(one & (kind == of) & differs(c), finding(metric, cls, F.col(f"l.{c}"), F.col(f"r.{c}")))
            for of, c, metric, cls in (
                ("split", "split_ratio", "split_ratio", "unresolved_discrepancy"),
                ("dividend", "amount", "dividend_amount", "unresolved_discrepancy"),
                ("dividend", "currency", "currency", "unresolved_discrepancy"),
                ("ticker_change", "old_ticker", "old_ticker", "definitional_difference"),
                ("ticker_change", "new_ticker", "new_ticker", "definitional_difference"),
            )
        ),
    ]
    listed = both.select(*keys, "lraw", "rraw", F.explode(F.array_compact(F.array(*found))).alias("f"))
    return listed.select(*keys, "f.*", F.col("lraw").alias("left_raw"), F.col("rraw").alias("right_raw"))


def action_metrics(left: DataFrame, right: DataFrame, providers: tuple[str, str]) -> DataFrame:
    """One row a provider: observations, unique keys and surplus rows, from one pass over the keys."""
    totals = []
    for n, provider in zip("lr", providers, strict=True):
        rows = F.col(f"{n}n")
        totals.append(F.struct(F.lit(provider).alias("provider"), F.coalesce(F.sum(rows), F.lit(0)).alias("observations"), F.count_if(rows > 0).alias("unique_keys"), F.coalesce(F.sum(F.when(rows > 0, rows - 1)), F.lit(0)).alias("duplicates")))
    return keyed_actions(left, right).agg(F.array(*totals).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def action_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action_type").agg(F.count(F.lit(1)).alias("actions"), F.count_distinct("raw_batch_id").alias("batches"))


def in_range(day: Column, start: Column, end: Column) -> Column:
    """Half-open containment of a date."""
    return (day >= start) & (day < end)
