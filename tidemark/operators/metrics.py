"""Per-batch and per-provider pipeline metrics, evidence tables and acceptance. Values and ids of bars never leave these tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import new_york_date
from tidemark.sources.raw import parsed, safe_number

_OHLC = ("open", "high", "low", "close")


#: Numbers that a batch's request metadata may hold.
RUNTIME = ("page_number", "response_status", "latency_ms", "rate_limit_capacity", "rate_limit_remaining", "api_credits_used")


def counts_of(rows: DataFrame, by: str, code: str, name: str) -> DataFrame:
    """`by` and `name`, a map from each code (sorted) to its rows. The map is as long as the vocabulary of codes."""
    counts = rows.groupBy(by, code).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(code, "n")))).alias(name))


def batch_metrics(pages: DataFrame, bars: DataFrame, issues: DataFrame, batch_errors: DataFrame | None = None) -> DataFrame:
    """Per raw batch: payload size, rows, issues and flags with counts by code, months stored, numbers of its request, and passes.

    A batch passes with rows and without an error issue; a batch error counts as one. pages has raw_batch_id, payload and, if known, provider, dataset
    and request_metadata.
    """
    month = F.struct("timeframe", F.trunc("timestamp_start", "month"))
    rows = bars.groupBy("raw_batch_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("quality_flags")).alias("flags"), F.count_distinct(month).alias("parts"))
    found = issues.groupBy("raw_batch_id").agg(F.count(F.lit(1)).alias("issues"), F.count_if(F.col("severity") == "error").alias("errors"))
    if batch_errors is not None:
        issues = issues.select("raw_batch_id", "code", "severity").unionByName(batch_errors.select("raw_batch_id", F.col("reason").alias("code"), F.lit("error").alias("severity")))
        found = issues.groupBy("raw_batch_id").agg(F.count(F.lit(1)).alias("issues"), F.count_if(F.col("severity") == "error").alias("errors"))
    flag_counts = counts_of(bars.select("raw_batch_id", F.explode("quality_flags").alias("flag")), "raw_batch_id", "flag", "flag_counts")
    known = [c for c in ("provider", "dataset") if c in pages.columns]
    number = lambda n: safe_number(F.col("request_metadata")[n]) if "request_metadata" in pages.columns else F.lit(None).cast("double")
    x = pages.select("raw_batch_id", *known, F.octet_length("payload").cast("long").alias("bytes"), *(number(n).alias(n) for n in RUNTIME))
    for y in (rows, found, counts_of(issues, "raw_batch_id", "code", "issue_counts"), flag_counts):
        x = x.join(y, "raw_batch_id", "left")
    x = x.fillna(0, ["rows", "flags", "parts", "issues", "errors"])
    no_counts = F.create_map().cast("map<string,bigint>")
    return x.withColumns({"issue_counts": F.coalesce("issue_counts", no_counts), "flag_counts": F.coalesce("flag_counts", no_counts), "passed": (F.col("rows") > 0) & (F.col("errors") == 0)})


def merged_counts(rows: DataFrame, by: str, counts: str) -> DataFrame:
    """`by` and the sum of the count maps in `counts`, in order of their codes."""
    flat = rows.select(by, F.explode(counts).alias("code", "n")).groupBy(by, "code").agg(F.sum("n").alias("n"))
    return flat.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "n")))).alias(counts))


def pipeline_summary(batches: DataFrame, by: str) -> DataFrame:
    """Sums and merged count maps (those that there are) of batch metrics, latencies, least remaining requests and most credits.

    A provider passes if it has batches and rows and all batches pass.
    """
    sums = [F.sum(c).alias(c) for c in ("bytes", "rows", "issues", "errors", "flags", "parts")]
    g = batches.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"), *sums, F.bool_and("passed").alias("all_passed"),
        F.count("latency_ms").alias("latencies"), F.sum("latency_ms").alias("latency_sum"), F.max("latency_ms").alias("latency_max"),
        F.min("rate_limit_remaining").alias("remaining_min"), F.count("api_credits_used").alias("credit_samples"), F.max("api_credits_used").alias("credits_max"),
    )
    for counts in (c for c in ("issue_counts", "flag_counts") if c in batches.columns):
        g = g.join(merged_counts(batches, by, counts), by, "left").withColumn(counts, F.coalesce(counts, F.create_map().cast("map<string,bigint>")))
    return g.withColumn("pipeline_pass", (F.col("batches") > 0) & (F.col("rows") > 0) & F.col("all_passed")).drop("all_passed")


def page_totals(pages: DataFrame, by: str) -> DataFrame:
    """Pages, bytes and latency of auxiliary requests (reference data, corporate actions)."""
    latency = safe_number(F.col("request_metadata")["latency_ms"])
    return pages.groupBy(by).agg(F.count(F.lit(1)).alias("pages"), F.sum(F.octet_length("payload").cast("long")).alias("bytes"), F.max(latency).alias("latency_max"))


def action_summary(pages: DataFrame, actions: DataFrame, issues: DataFrame, by: str = "provider") -> DataFrame:
    """Per provider: page totals, actions with counts by type, and issues by code. All three frames have `by`."""
    x = page_totals(pages, by).join(actions.groupBy(by).agg(F.count(F.lit(1)).alias("actions")), by, "left").fillna(0, ["actions"])
    return x.join(counts_of(actions, by, "action_type", "type_counts"), by, "left").join(counts_of(issues, by, "code", "issue_counts"), by, "left")


def write_results(tables: dict[str, DataFrame], root: str) -> None:
    """Write aggregate tables as Parquet under root, one folder each. A table with a column of ids, prices or values is refused."""
    private = {"raw_batch_id", "instrument_id", "source_id", "provider_record_id", "request_id", "payload", "manifest", "left_number", "right_number", "left_text", "right_text", "volume", "vwap", *_OHLC}
    for name, df in tables.items():
        shown = {c.lower() for c in df.columns} & private
        if shown:
            raise ValueError(f"{name} has columns that may not leave a run: {sorted(shown)}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")


def acceptance(summary: DataFrame, checks: dict[str, Column], by: str) -> DataFrame:
    """(by, check, verdict): PASS or FAIL for each check of each row; a null is a failure."""
    pairs = F.array(*(F.struct(F.lit(k).alias("check"), F.when(v, "PASS").otherwise("FAIL").alias("verdict")) for k, v in checks.items()))
    return summary.select(by, F.explode(pairs).alias("x")).select(by, "x.*")


def daily_ohlc(bars: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last bar (by `order`) of each key and New York date, as (keys, day, v)."""
    return bars.groupBy(*keys, new_york_date(F.col("timestamp_start")).alias("day")).agg(F.max_by(F.struct(*_OHLC), F.struct(*order)).alias("v"))


def evidence_series(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Daily prices straight from raw pages, as (keys, day, v): the last readable record of each date wins, others are skipped.

    pages: keys, symbol, payload, and page_number for the order of pages. Records are a symbol's list under `bars`, or the
    `values` of the page or of the symbol's part of it; prices are numbers or text that reads as one.
    """
    root = F.col("_v")
    name = F.concat(F.lit("$[\""), F.col("symbol"), F.lit("\"]"))
    fields = ("t", "datetime", *(n for c in _OHLC for n in (c[0], c)))
    kind = f"array<struct<{', '.join(f'{n}: variant' for n in fields)}>>"
    records = lambda body, path: F.try_variant_get(body, path, kind)
    listed = F.coalesce(records(F.try_variant_get(root, "$.bars", "variant"), name), records(root, "$.values"), records(F.try_variant_get(root, name, "variant"), "$.values"))

    def typed(r: Column) -> Column:
        """A record's day and prices; a price is a number or a text that reads as one, which true and false don't."""
        shown = lambda v: F.try_variant_get(v, "$", "string")
        stamp = F.coalesce(r["t"], r["datetime"])
        day = F.when(F.schema_of_variant(stamp) == "STRING", shown(stamp).substr(1, 10))
        return F.struct(day.alias("day"), *(shown(F.coalesce(r[c[0]], r[c])).try_cast("double").alias(c) for c in _OHLC))

    # a page is parsed and its records are typed by one cast, before they come apart; generated columns are computed once
    read = pages.select(*keys, "symbol", "page_number", F.inline(F.array(F.struct(parsed(F.col("payload")).alias("_v")))))
    rows = read.select(*keys, "page_number", F.posexplode(F.transform(listed, typed)).alias("at", "r"))
    x = rows.select(*keys, "page_number", "at", "r.*").dropna(subset=["day", *_OHLC])
    return x.groupBy(*keys, "day").agg(F.max_by(F.struct(*_OHLC), F.struct("page_number", "at")).alias("v"))


def compared_with(evidence: DataFrame, baseline: Column, by: list[str], on: list[str]) -> DataFrame:
    """compared_series() with those rows of evidence that meet a condition, at most one for each `on`. Evidence dealt by one of `on` isn't shuffled again."""
    own = F.max(F.when(baseline, F.struct(F.lit(True).alias("there"), F.col("v")))).over(W.partitionBy(*on))
    both = evidence.withColumn("b", own).filter("b IS NOT NULL")
    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("v").eqNullSafe(F.col("b.v"))).alias("different"))


def compared_series(evidence: DataFrame, baseline: DataFrame, by: list[str], on: list[str]) -> DataFrame:
    """Per `by`: keys of both series (`on`, v), and those with other prices. The baseline has the keys `on` alone."""
    both = evidence.withColumnRenamed("v", "a").join(baseline.withColumnRenamed("v", "b"), on)
    return both.groupBy(*by).agg(F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


def adjustment_evidence(evidence: DataFrame, baseline: DataFrame, provider: str | None = None) -> DataFrame:
    """Per adjustment (and provider): pages and rows of evidence, dates compared with the baseline, and dates with other prices.

    evidence: adjustment, raw_batch_id and bar columns; baseline: unadjusted bars. `provider` names a column that both have.
    """
    order, own = ["timestamp_start", "raw_batch_id", *_OHLC], [provider] if provider else []
    by = [*own, "adjustment"]
    shown = evidence.groupBy(*by).agg(F.count_distinct("raw_batch_id").alias("pages"), F.count(F.lit(1)).alias("rows"))
    a, b = daily_ohlc(evidence, [*by, "instrument_id"], order), daily_ohlc(baseline, [*own, "instrument_id"], order)
    return shown.join(compared_series(a, b, by, [*own, "instrument_id", "day"]), by, "left").fillna(0, ["compared", "different"])


def continuity(rows: DataFrame, mapped: Column) -> DataFrame:
    """Rows and pages of mapped and of unmapped symbols."""
    return rows.groupBy(F.when(mapped, "mapped").otherwise("unmapped").alias("mode")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("raw_batch_id").alias("pages"))
