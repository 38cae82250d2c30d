"""Canonical coercion of bars and its checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import canonical_uuid, finite, strip
from tidemark.schemas import ADJUSTMENTS, BAR_COLUMNS, BAR_SCHEMA, FLOAT_COLUMNS, NULLABLE, SESSIONS, TIMEFRAMES, UUID_COLUMNS


class CanonicalError(ValueError):
    """The frame can't be taken as canonical bars."""


def check_columns(df: DataFrame) -> None:
    """The exact set of columns, with timestamps that have a zone and flags that are strings."""
    missing, extra = set(BAR_COLUMNS) - set(df.columns), set(df.columns) - set(BAR_COLUMNS)
    if missing or extra:
        raise CanonicalError(f"missing columns {sorted(missing)}, extra columns {sorted(extra)}")
    for field in df.schema:
        want = BAR_SCHEMA[field.name].dataType
        if isinstance(want, T.TimestampType) and not isinstance(field.dataType, T.TimestampType) and not (field.name == "available_at" and isinstance(field.dataType, T.NullType)):
            raise CanonicalError(f"{field.name} must be a timestamp with a zone")
        if field.name == "quality_flags" and not isinstance(field.dataType, T.NullType):
            inner = getattr(field.dataType, "elementType", None)
            if not isinstance(inner, (T.StringType, T.NullType)):
                raise CanonicalError("quality_flags must be a list of strings")


def trimmed_flags(flags: Column) -> Column:
    return F.transform(F.coalesce(flags.cast("array<string>"), F.array().cast("array<string>")), strip)


def violations() -> dict[str, Column]:
    """Conditions that reject a row, by check, in order."""
    flags = trimmed_flags(F.col("quality_flags"))
    required = [c for c in BAR_COLUMNS if c not in NULLABLE and c != "quality_flags"]
    bad = {f"null_{c}": F.col(c).isNull() for c in required}
    bad |= {f"not_finite_{c}": ~finite(F.col(c)) for c in FLOAT_COLUMNS}
    bad["blank_flag"] = F.exists(flags, lambda x: x.isNull() | (x == ""))
    bad |= {f"not_uuid_{c}": canonical_uuid(F.col(c)).isNull() & F.col(c).isNotNull() for c in UUID_COLUMNS}
    bad["empty_interval"] = F.col("timestamp_end") <= F.col("timestamp_start")
    bad["ingested_before_retrieved"] = F.col("ingested_at") < F.col("retrieved_at")
    for c, allowed in (("timeframe", TIMEFRAMES), ("session", SESSIONS), ("adjustment_state", ADJUSTMENTS)):
        bad[f"unknown_{c}"] = ~F.col(c).isin(*allowed)
    return {k: F.coalesce(v, F.lit(False)) for k, v in bad.items()}


def violation_counts(df: DataFrame) -> DataFrame:
    """(check, rows) for every check, in one pass over the data."""
    found = violations()
    counts = df.agg(*(F.count_if(v).alias(k) for k, v in found.items()))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).alias("rows")) for k in found))).alias("x")).select("x.*")


def _shaped(plain: DataFrame) -> DataFrame:
    shaped = {c: canonical_uuid(F.col(c)) for c in UUID_COLUMNS}
    shaped["quality_flags"] = F.array_sort(trimmed_flags(F.col("quality_flags")))
    return plain.withColumns(shaped).select(*BAR_COLUMNS)


def _plain(df: DataFrame) -> DataFrame:
    check_columns(df)
    return df.select(*(F.col(f.name).cast("array<string>" if f.name == "quality_flags" else f.dataType).alias(f.name) for f in BAR_SCHEMA))


def coerce(df: DataFrame, verify: bool = True) -> DataFrame:
    """The frame cast to the canonical schema, UUIDs canonical, flags trimmed and sorted. With verify, one aggregate fails on any bad row."""
    plain = _plain(df)
    if verify:
        counts = plain.agg(*(F.count_if(v).alias(k) for k, v in violations().items())).first().asDict()
        failed = {k: n for k, n in counts.items() if n}
        if failed:
            raise CanonicalError(f"rows failing checks: {failed}")
    return _shaped(plain)


def coerce_watched(df: DataFrame) -> tuple[DataFrame, Callable[[], None]]:
    """The coerced frame and a check for after the job that computes its rows (one at least), which fails if any row broke a rule.

    Violations are counted as rows pass, so a job that writes the frame reads its input once.
    """
    watch = Observation()
    seen = _plain(df).observe(watch, *(F.count_if(v).alias(k) for k, v in violations().items()))

    def check() -> None:
        failed = {k: n for k, n in watch.get.items() if n}
        if failed:
            raise CanonicalError(f"rows failing checks: {failed}")

    return _shaped(seen), check


def empty_bars(spark) -> DataFrame:
    return spark.createDataFrame([], BAR_SCHEMA)


def row_digest(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Which columns are null and how long lists are goes first, as hashes of columns pass over nulls."""
    shape = F.concat(*(F.when(F.col(c).isNull(), "n").otherwise(F.concat(F.size(c).cast("string"), F.lit(";")) if c == "quality_flags" else F.lit("v")) for c in columns))
    return [F.xxhash64(F.lit(i), shape, *columns).alias(f"_digest{i}") for i in range(2)]


def frame_differences(a: DataFrame, b: DataFrame, columns: Sequence[str] = BAR_COLUMNS, shown: Sequence[str] | None = None) -> DataFrame:
    """Rows that one frame holds more often than the other, with `surplus`: above zero, so many more in a. Lists of flags compare sorted.

    Both frames meet in one aggregation, so each is read and shuffled once, and equal rows meet on the map side first. With `shown`
    only these columns are given; rows then meet by them and a digest of 128 bits of all columns, so the rest isn't shuffled.
    """
    kept = columns if shown is None else shown

    def counted(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select(*(F.array_sort(F.col(c)).alias(c) if c == "quality_flags" else F.col(c) for c in columns))
        return rows.select(*kept, *([] if shown is None else row_digest(columns)), F.lit(sign).alias("surplus"))

    every = counted(a, 1).unionByName(counted(b, -1))
    return every.groupBy(*every.columns[:-1]).agg(F.sum("surplus").alias("surplus")).filter("surplus <> 0").select(*kept, "surplus")


def frames_match(a: DataFrame, b: DataFrame, columns: Sequence[str] = BAR_COLUMNS) -> bool:
    """Equal as multisets of rows."""
    return frame_differences(a, b, columns, ()).isEmpty()
