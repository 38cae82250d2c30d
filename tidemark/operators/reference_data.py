"""Point-in-time identifiers and memberships, reference matches, request manifests and plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import name_uuid, strip
from tidemark.sources.files import scratch_folder


def source_dimension(listing: DataFrame, namespace: str) -> DataFrame:
    """Sources with their ids: a listing (name, provider, dataset, endpoint, ...) with `source_id`, the version-5 UUID of the name, each name once.

    The listing is a vocabulary, a row for each kind of data that a provider serves. Two listings of a name that say different
    things, or a blank name, provider, dataset or endpoint, are an error.
    """
    said = [c for c in listing.columns if c != "name"]
    once = listing.groupBy("name").agg(F.collect_set(F.struct(*said)).alias("_said"))
    blank = F.lit(False)
    for c in ("provider", "dataset", "endpoint"):
        blank = blank | (F.coalesce(strip(F.col("_said")[0][c]), F.lit("")) == "")
    blank = blank | (F.coalesce(strip(F.col("name")), F.lit("")) == "")
    told = F.when(F.size("_said") != 1, F.raise_error(F.concat(F.lit("a source is listed in several ways: "), "name")).cast("string"))
    told = told.when(blank, F.raise_error(F.lit("a source needs a name, provider, dataset and endpoint")).cast("string")).otherwise(name_uuid(namespace, F.col("name")))
    return once.select(told.alias("source_id"), "name", F.col("_said")[0].alias("_one")).select("source_id", "name", "_one.*")


def valid_on(day: Column, start: Column, end: Column) -> Column:
    """Half-open validity with an open end."""
    return (start <= day) & (end.isNull() | (day < end))


def as_of(facts: DataFrame, history: DataFrame, on: Sequence[str], day: str, how: str = "inner") -> DataFrame:
    """facts joined with the rows of history (valid_from, valid_to) that hold on the fact's day: an equi-join on `on` with the interval as a condition."""
    f, h = facts.alias("f"), history.alias("h")
    cond = valid_on(F.col(f"f.{day}"), F.col("h.valid_from"), F.col("h.valid_to"))
    for c in on:
        cond = cond & (F.col(f"f.{c}") == F.col(f"h.{c}"))
    return f.join(h, cond, how).select("f.*", *(F.col(f"h.{c}") for c in history.columns if c not in facts.columns))


def is_us_equity(asset_class: Column, country: Column, kind: Column) -> Column:
    """A reference row is a US equity in either wire spelling: by its asset class, or by its country and instrument type."""
    countries, kinds = ("united states", "us", "usa"), ("common stock", "etf", "exchange-traded fund", "american depositary receipt")
    tidy = lambda c: F.lower(F.trim(c))
    return F.coalesce(tidy(asset_class) == "us_equity", F.lit(False)) | F.coalesce(tidy(country).isin(*countries) & tidy(kind).isin(*kinds), F.lit(False))


def reference_matches(requested: DataFrame, rows: DataFrame, on: str) -> DataFrame:
    """One row: securities requested, and those that some row of the reference resolves (rows has a boolean `match`)."""
    by = requested.select(on).distinct().join(rows, on, "left").groupBy(on).agg(F.coalesce(F.bool_or("match"), F.lit(False)).alias("match"))
    return by.agg(F.count(F.lit(1)).alias("requested"), F.count_if("match").alias("resolved"))


def refs_fingerprint(refs: DataFrame) -> DataFrame:
    """request_id, the version-1 manifest of its sorted (instrument, identifier) pairs, and its SHA-256; the order of rows doesn't matter.

    Pairs are made distinct before they are collected, so an array is as long as the request's distinct pairs.
    """
    rows = refs.groupBy("request_id", "instrument_id", "provider_identifier").agg(F.count(F.lit(1)).alias("rows"))
    pairs = F.array_sort(F.collect_list(F.struct("instrument_id", "provider_identifier")))
    listed = rows.groupBy("request_id").agg(F.to_json(F.struct(pairs.alias("references"), F.lit(1).alias("version"))).alias("manifest"), F.sum("rows").alias("refs"))
    return listed.withColumn("fingerprint", F.sha2("manifest", 256))


def bad_identifier(c: Column) -> Column:
    """Blank, or with a comma or a control character, which would change a joined list."""
    return c.isNull() | (F.trim(c) == "") | c.rlike(r"[,\x00-\x1f\x7f]")


def numbered(rows: DataFrame, by: str, order: str, name: str) -> DataFrame:
    """rows with their place, from 0, among the rows of equal `by` in the order of `order`.

    Rows are range-partitioned by both and written once; partitions are counted, the few counts of each `by` turn into offsets,
    and rows are numbered within their partition. So a `by` with any share of all rows is as many tasks as it fills partitions.
    """
    spark, path = rows.sparkSession, scratch_folder(rows.sparkSession, "numbered")
    rows.repartitionByRange(F.col(by), F.col(order)).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
    counts = dealt.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(W.partitionBy("_by").orderBy("_of").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("_by", "_of", F.coalesce(earlier, F.lit(0)).alias("_before"))
    own = dealt.withColumn("_at", F.row_number().over(W.partitionBy(by, "_part").orderBy(order)) - 1)
    placed = own.join(offsets, own[by].eqNullSafe(offsets["_by"]) & (own["_part"] == offsets["_of"]))
    return placed.select(*rows.columns, (F.col("_before") + F.col("_at")).alias(name))


def request_plan(targets: DataFrame, window: str, order: str, size: int, by_reference: bool) -> DataFrame:
    """Targets of each window in batches of `size`: batch number, members in order, and the credits (a member each, or one)."""
    batch = numbered(targets, window, order, "_place").withColumn("batch", F.floor(F.col("_place") / size) + 1)
    plan = batch.groupBy(window, "batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", order))), lambda x: x[order]).alias("members"), F.count(F.lit(1)).alias("refs"))
    return plan.withColumn("credits", F.col("refs") if by_reference else F.lit(1).cast("long"))


def identifiers_long(securities: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Wide identifier columns (provider -> column) as rows: key, provider, identifier."""
    pairs = F.array(*(F.struct(F.lit(p).alias("provider"), F.col(c).alias("identifier")) for p, c in columns.items()))
    return securities.select(key, F.explode(pairs).alias("x")).select(key, "x.provider", "x.identifier").filter("identifier IS NOT NULL")
