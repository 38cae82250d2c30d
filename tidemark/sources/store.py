"""Canonical bars as partitioned Parquet."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.canonical import CanonicalError, coerce_watched, empty_bars
from tidemark.schemas import ADJUSTMENTS, BAR_COLUMNS, BAR_SCHEMA, SESSIONS, TIMEFRAMES
from tidemark.sources.files import create_marker, delete, names_in

_ON_DISK = T.StructType([*BAR_SCHEMA.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
_SORT = tuple(c for c in BAR_COLUMNS if c != "quality_flags")


@dataclass(frozen=True)
class BarQuery:
    """Filters of a scan: any of them may be left out; [start, end) are aware instants, ids are UUIDs in any spelling."""

    instruments: tuple[str, ...] = ()
    sources: tuple[str, ...] = ()
    timeframe: str | None = None
    session: str | None = None
    adjustment_state: str | None = None
    start: datetime | None = None
    end: datetime | None = None

    def __post_init__(self) -> None:
        for name, allowed in (("timeframe", TIMEFRAMES), ("session", SESSIONS), ("adjustment_state", ADJUSTMENTS)):
            value = getattr(self, name)
            if value is not None and value not in allowed:
                raise ValueError(f"unknown {name}: {value!r}")
        for name in ("instruments", "sources"):
            object.__setattr__(self, name, tuple(str(uuid.UUID(x)) for x in getattr(self, name)))
        for bound in (self.start, self.end):
            if bound is not None and bound.tzinfo is None:
                raise ValueError("bounds need a zone")
        if self.start and self.end and self.end <= self.start:
            raise ValueError("the end must come after the start")


def apply_query(bars: DataFrame, query: BarQuery, partitioned: bool = False) -> DataFrame:
    """Filter and order. On a partitioned scan, bounds become predicates on year and month too, so folders are pruned."""
    for name, values in (("instrument_id", query.instruments), ("source_id", query.sources)):
        if values:
            bars = bars.filter(F.col(name).isin(*values))
    for name in ("timeframe", "session", "adjustment_state"):
        if getattr(query, name) is not None:
            bars = bars.filter(F.col(name) == getattr(query, name))
    ordinal = F.col("year") * 12 + F.col("month") if partitioned else None
    if query.start:
        at = query.start.astimezone(UTC)
        bars = bars.filter(F.col("timestamp_start") >= F.lit(at))
        bars = bars.filter((F.col("year") >= at.year) & (ordinal >= at.year * 12 + at.month)) if partitioned else bars
    if query.end:
        at = query.end.astimezone(UTC)
        bars = bars.filter(F.col("timestamp_start") < F.lit(at))
        bars = bars.filter((F.col("year") <= at.year) & (ordinal <= at.year * 12 + at.month)) if partitioned else bars
    return bars.select(*BAR_COLUMNS)


def ordered(bars: DataFrame) -> DataFrame:
    return bars.orderBy("timestamp_start", "instrument_id", "source_id", "adjustment_state", "session")


def digests() -> list[Column]:
    """Rows of a frame of bars, and a digest of them, batch ids and all, that doesn't depend on their order (sum of 64-bit hashes)."""
    row = F.xxhash64(*(F.array_sort(F.col(c)) if c == "quality_flags" else F.col(c) for c in BAR_COLUMNS))
    return [F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("digest")]


def partition_keys(bars: DataFrame) -> DataFrame:
    return bars.select("timeframe", F.year("timestamp_start").alias("year"), F.month("timestamp_start").alias("month")).distinct()


_PUBLISH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,127}")
_REGISTRY = "raw_batch_id string, rows long"


class BarStore:
    """Append-only store. Each append is a publish of its own:

    root/data/publish=ID/timeframe=/year=/month= has its bars, root/batches/publish=ID its raw batch ids with their rows, and
    root/published/ID is an empty marker, created in one step once both are whole. Readers see marked publishes only, so an
    append that dies before its marker leaves nothing visible, and the same publish id can be written again over it. Batch ids
    are looked up in the registry, which has a row a batch; the bars of the store are never scanned for it. One writer at a
    time may append to a store; readers need no lock.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def publishes(self) -> list[str]:
        return names_in(self.spark, f"{self.root}/published")

    def published_batches(self) -> DataFrame:
        """raw_batch_id and rows of all published batches."""
        done = self.publishes()
        if not done:
            return self.spark.createDataFrame([], _REGISTRY)
        return self.spark.read.schema(f"{_REGISTRY}, publish string").parquet(f"{self.root}/batches").filter(F.col("publish").isin(done)).drop("publish")

    def append(self, bars: DataFrame, batches: DataFrame | None = None, publish_id: str | None = None, watch: Observation | None = None) -> bool:
        """Coerce and write bars of batches that aren't there yet, in one pass over them. `batches` (raw_batch_id) lists the ids that bars may have.

        An empty frame, a row that breaks a rule, a batch already published or a row of another batch fails the call and leaves
        the store as it was. With `publish_id`, a call whose id is already published does nothing and returns False. Rows of a
        month meet by a hash of month and instrument, so that no month is written by one task. `watch` observes digests() of the
        rows as they are written.
        """
        publish = publish_id or uuid.uuid4().hex
        if not _PUBLISH_ID.fullmatch(publish):
            raise ValueError(f"a publish id has letters, digits, dots, dashes and underscores: {publish!r}")
        if publish in self.publishes():
            return False
        data, registry = f"{self.root}/data/publish={publish}", f"{self.root}/batches/publish={publish}"
        ready, check = coerce_watched(bars)
        dated = ready.withColumns({"year": F.year("timestamp_start"), "month": F.month("timestamp_start"), "_part": F.pmod(F.xxhash64("instrument_id"), F.lit(8))})
        dealt = dated.repartition("timeframe", "year", "month", "_part").drop("_part").sortWithinPartitions("year", "month", *(F.col(c).asc_nulls_last() for c in _SORT))
        dealt = dealt if watch is None else dealt.observe(watch, *digests())
        try:
            dealt.write.mode("overwrite").partitionBy("timeframe", "year", "month").option("compression", "zstd").parquet(data)
            ids = self.spark.read.schema(_ON_DISK).parquet(data).groupBy("raw_batch_id").agg(F.count(F.lit(1)).alias("rows"))
            ids.write.mode("overwrite").parquet(registry)
            ids = self.spark.read.schema(_REGISTRY).parquet(registry)
            if ids.isEmpty():
                raise CanonicalError("there are no bars to append")
            check()
            if batches is not None and not ids.join(batches, "raw_batch_id", "left_anti").isEmpty():
                raise CanonicalError("bars of another raw batch")
            if not ids.join(self.published_batches(), "raw_batch_id", "left_semi").isEmpty():
                raise CanonicalError("a raw batch is already published")
        except Exception:
            for path in (data, registry):
                delete(self.spark, path)
            raise
        self._commit(publish)
        return True

    def _commit(self, publish: str) -> None:
        if not create_marker(self.spark, f"{self.root}/published/{publish}"):
            raise CanonicalError(f"{publish} was published by another writer")

    def _scan(self) -> DataFrame | None:
        done = self.publishes()
        if not done:
            return None
        return self.spark.read.schema(T.StructType([*_ON_DISK.fields, T.StructField("publish", T.StringType())])).parquet(f"{self.root}/data").filter(F.col("publish").isin(done))

    def query(self, query: BarQuery = BarQuery()) -> DataFrame:
        files = self._scan()
        return empty_bars(self.spark) if files is None else ordered(apply_query(files, query, partitioned=True))

    def batches_read(self, ids: DataFrame) -> DataFrame:
        """Bars of these raw batches (raw_batch_id), in no order. If the registry holds no other batch, nothing is joined."""
        files = self._scan()
        if files is None:
            return empty_bars(self.spark)
        bars = apply_query(files, BarQuery(), partitioned=True)
        others = self.published_batches().join(ids, "raw_batch_id", "left_anti")
        return bars if others.isEmpty() else bars.join(ids, "raw_batch_id", "left_semi")
