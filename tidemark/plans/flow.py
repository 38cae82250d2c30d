"""The whole flow of a set of landed pages: land, recheck, bind to requests, normalize once, validate, store, read back, compare, measure."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.metrics import batch_metrics
from tidemark.operators.validation import ValidationPolicy, validate_bars
from tidemark.sources import raw
from tidemark.sources.files import scratch_folder
from tidemark.sources.normalize import BAR_NORMALIZERS, Normalized, bind, stored
from tidemark.sources.store import BarStore, digests


class FlowError(RuntimeError):
    """What was read back isn't what was written."""


@dataclass(frozen=True)
class Processed:
    """Metrics of each batch (with the flow's checks), issues of records, and batches that couldn't be read, with the reason."""

    metrics: DataFrame
    issues: DataFrame
    batch_errors: DataFrame


def bound_normalizer(shape: str, requests: DataFrame, refs: DataFrame, sessions: DataFrame) -> Callable[[DataFrame], Normalized]:
    """A normalizer of landed pages, as land() writes them: each page is bound to its request first, and an unbound one is a batch error."""

    def normalize(landed: DataFrame) -> Normalized:
        return BAR_NORMALIZERS[shape](bind(landed.withColumn("raw_batch_id", F.col("batch_id")), requests), refs, sessions)

    return normalize


def process_pages(batches: DataFrame, requests: DataFrame, shape: str, refs: DataFrame, sessions: DataFrame, raw_root: str, store: BarStore, policy: ValidationPolicy = ValidationPolicy(duplicate_scope="batch")) -> Processed:
    """Process raw batches whose request_id names a row of requests (request_id, source_id, expected_metadata, ...).

    Pages are parsed once. A page without its request, or one that can't be read, has no rows and an error in the result. The
    metrics tell for each batch whether it was landed before (`replayed`) and that its payload, its rows in the store and the
    rows read back are whole; a payload that fails its checksum or a batch that reads back otherwise fails the call.
    """
    spark = batches.sparkSession
    landing = raw.land(batches, raw_root)
    ids = landing.select("batch_id")
    landed = raw.landed_batches(spark, raw_root, ids)
    if not raw.integrity_errors(landed).isEmpty():
        raise FlowError("a landed payload fails its checksum")
    found = stored(bound_normalizer(shape, requests, refs, sessions)(landed), scratch_folder(spark, "outcome"))
    bars = validate_bars(found.rows, policy)
    ids = ids.withColumnRenamed("batch_id", "raw_batch_id")
    written, back = Observation(), store.batches_read(ids)
    if not found.rows.isEmpty():
        store.append(bars, ids, watch=written)
        back = store.batches_read(ids)
        if back.agg(*digests()).first().asDict() != written.get:
            raise FlowError("the store gave back other bars than were written")
    elif not back.isEmpty():
        raise FlowError("the store has bars of batches that have none")
    pages = landed.withColumn("raw_batch_id", F.col("batch_id"))
    m = batch_metrics(pages, back, found.issues, found.batch_errors).join(landing.select(F.col("batch_id").alias("raw_batch_id"), (F.col("landing") == "replay").alias("replayed")), "raw_batch_id", "left")
    passes = {"raw_pass": F.lit(True), "replay_pass": F.lit(True), "normalization_pass": F.col("errors") == 0, "stored_pass": (F.col("rows") == 0) | (F.col("parts") > 0), "query_pass": F.lit(True)}
    return Processed(m.withColumns(passes), found.issues, found.batch_errors)
