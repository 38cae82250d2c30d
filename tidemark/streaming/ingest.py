"""Progressive ingestion: pages that land() writes go through binding, normalization, validation and the store.

A stream reads new landed files with an explicit schema. Every micro-batch is one publish of the store, named by the stream
and the micro-batch's number, so a micro-batch that runs again after a failure, before or after its commit, changes nothing
more. Its pages are parsed once, into an outcome table from which bars, issues and batch errors are read. A batch id that the
registry of the store already holds is skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.validation import ValidationPolicy, validate_bars
from tidemark.sources.files import names_in
from tidemark.sources.normalize import Normalized, split_outcome, stored
from tidemark.sources.raw import integrity_errors
from tidemark.sources.store import BarStore


def unpublished(pages: DataFrame, store: BarStore, key: str) -> DataFrame:
    """Pages whose batch the store's registry doesn't hold. Ids meet the registry first, so payloads are shuffled only if it holds some of them."""
    if not store.publishes():
        return pages
    held = pages.select(key).join(store.published_batches().select(F.col("raw_batch_id").alias(key)), key, "left_semi")
    return pages if held.isEmpty() else pages.join(held, key, "left_anti")


def ingest_available(
    spark: SparkSession, landing: str, schema: T.StructType, normalizer: Callable[[DataFrame], Normalized], store: BarStore, checkpoint: str, side: str, policy: ValidationPolicy = ValidationPolicy(duplicate_scope="batch"), files_per_trigger: int = 100, name: str = "stream"
) -> None:
    """Process all pages in the landing folder that weren't seen yet, then stop.

    The outcome of each micro-batch stays in side/micro_batch=N, which a repeated micro-batch overwrites. Pages with a manifest are
    checked against it first; a spoiled page fails the stream.
    """

    def step(pages: DataFrame, number: int) -> None:
        publish = f"{name}-{number}"
        if publish in store.publishes():
            return
        if "manifest" in pages.columns and not integrity_errors(pages).isEmpty():
            raise ValueError("a landed payload fails its checksum")
        key = "raw_batch_id" if "raw_batch_id" in pages.columns else "batch_id"
        fresh = unpublished(pages, store, key)
        found = stored(normalizer(fresh), f"{side.rstrip('/')}/micro_batch={number}")
        if not found.rows.isEmpty():
            store.append(validate_bars(found.rows, policy), publish_id=publish)

    pages = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(landing)
    query = pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def ingested(spark: SparkSession, side: str, schema: T.StructType) -> Normalized | None:
    """Rows, issues and batch errors of all micro-batches so far; schema is the outcome's."""
    if not names_in(spark, side):
        return None
    return split_outcome(spark.read.schema(T.StructType([*schema.fields, T.StructField("micro_batch", T.LongType())])).parquet(side))
