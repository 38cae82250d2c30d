"""Comparison of two providers' bars, finding by finding, without choosing a winner."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import iso
from tidemark.operators.matching import at_home, in_blocks, partners_in_blocks, unpaired
from tidemark.schemas import BAR_KEY, CLASSES, NUMERIC_METRICS

_ROW = ("timestamp_end", "session", "adjustment_state", "currency", *NUMERIC_METRICS)
#: Seconds of a block of observations that are matched together.
BLOCK_SECONDS = 21_600
#: Findings of a key come in this order.
METRIC_ORDER = ("duplicate_bar", "availability", "interval_boundary", "session", "adjustment", "currency", *NUMERIC_METRICS)


@dataclass(frozen=True)
class BarTolerance:
    price_absolute: float = 1e-9
    price_relative: float = 1e-8
    volume_absolute: float = 0.0
    volume_relative: float = 1e-8
    alignment_seconds: int = 60

    def __post_init__(self) -> None:
        numbers = (self.price_absolute, self.price_relative, self.volume_absolute, self.volume_relative)
        if any(not 0 <= x < float("inf") for x in numbers) or not 0 <= self.alignment_seconds <= 60:
            raise ValueError("tolerances must be finite and not negative, the alignment a minute at most")


@dataclass(frozen=True)
class BarComparison:
    left_provider: str
    right_provider: str
    tolerance: BarTolerance = field(default_factory=BarTolerance)
    venue_metrics: frozenset[str] = frozenset()
    excluded_metrics: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        names = [x.strip().casefold() for x in (self.left_provider, self.right_provider)]
        if not all(names) or names[0] == names[1]:
            raise ValueError("two distinct provider names are needed")
        chosen = self.venue_metrics | self.excluded_metrics
        if chosen - set(NUMERIC_METRICS) or self.venue_metrics & self.excluded_metrics:
            raise ValueError("metric sets must be numeric and disjoint")


def nearly_equal(a: Column, b: Column, absolute: float, relative: float) -> Column:
    """Both null, or within the larger of the absolute tolerance and the relative one of the larger magnitude."""
    close = F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
    return (a.isNull() & b.isNull()) | F.coalesce(close, F.lit(False)) | F.coalesce(a == b, F.lit(False))


def keyed_bars(left: DataFrame, right: DataFrame | None, expected: DataFrame | None, by: Sequence[str], seconds: int, wanted: Column | None = None, values: Sequence[str] = _ROW) -> DataFrame:
    """One row a key that either side has or that is expected, in blocks of observations (see in_blocks()), from one shuffle of all three.

    For left (l) and right (r): ln and rn count rows, lraw and rraw are the distinct raw batches sorted, l and r the `values` of a row (the
    row, where there is one); `wanted` tells whether the key is expected: one of `expected`, or of a left row that meets the condition `wanted`.
    Rows are dealt by instrument, timeframe and block, so rows of a key and keys to be matched meet in one partition and one order.
    """
    keys = [*by, *BAR_KEY]
    row = F.struct(*values)
    asked = F.lit(False) if wanted is None else F.coalesce(wanted, F.lit(False))
    sides = [x.select(*keys, F.lit(n).alias("_side"), (asked if n == 0 else F.lit(False)).alias("_wanted"), F.col("raw_batch_id").alias("_raw"), row.alias("_row")) for n, x in ((0, left), (1, right)) if x is not None]
    if expected is not None:
        kind = left.select(row.alias("x")).schema[0].dataType
        sides.append(expected.select(*keys, F.lit(2).alias("_side"), F.lit(True).alias("_wanted"), F.lit(None).cast("string").alias("_raw"), F.lit(None).cast(kind).alias("_row")))
    every = sides[0]
    for x in sides[1:]:
        every = every.unionByName(x)
    lines = [*by, "instrument_id", "timeframe"]
    where = (F.unix_micros("timestamp_start"), max(seconds, 1) * 1_000_000, BLOCK_SECONDS * 1_000_000)
    placed = at_home(in_blocks(every, *where).drop("_at", "_home").repartition(*lines, "_block"), *where).withColumn("_line", F.xxhash64(*lines, "_block"))
    order = W.partitionBy("_line", *lines, "_block", "_at").orderBy("_side")  # ids begin alike: a hash before them decides most comparisons
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    found = {"_place": F.row_number().over(order), "wanted": F.max("_wanted").over(whole)}
    for i, n in enumerate("lr"):
        own = F.col("_side") == i
        found |= {f"{n}n": F.count_if(own).over(whole), f"{n}raw": F.collect_set(F.when(own, F.col("_raw"))).over(whole), n: F.first(F.when(own, F.col("_row")), ignorenulls=True).over(whole)}
    one = placed.withColumns(found).filter("_place = 1").drop("_place", "_side", "_wanted", "_raw", "_row")
    return one.withColumns({f"{n}raw": F.sort_array(f"{n}raw") for n in "lr"})


def _matched(keyed: DataFrame, by: Sequence[str], seconds: int, roles: dict[str, tuple[Column, Column]], payload: Column | None = None) -> DataFrame:
    """Keyed bars, each in its own block only, with their partners by role."""
    if seconds <= 0:
        return unpaired(keyed.filter(F.col("_block").eqNullSafe(F.col("_home"))).drop("_at", "_home", "_block"), roles, payload)
    return partners_in_blocks(keyed, ["_line", *by, "instrument_id", "timeframe"], seconds * 1_000_000, roles, payload, unique=True)


def _aligned(keyed: DataFrame, by: Sequence[str], seconds: int, rows: bool = True) -> DataFrame:
    """Keyed bars where a single 5m row of the right side only, shifted by at most `seconds`, has moved to its partner's key on the left. Without `rows` only its start moves."""
    five = F.col("timeframe") == "5m"
    left = five & (F.col("ln") == 1) & (F.col("rn") == 0)
    right = five & (F.col("rn") == 1) & (F.col("ln") == 0)
    moving = ("rn", "rraw", "r") if rows else ()
    x = _matched(keyed, by, seconds, {"_shift": (left, right)}, F.struct(F.col("timestamp_start").alias("own_start"), *moving))
    at = F.col("_shift_partner")
    moved = {"own_start": F.when(at.isNotNull(), at.own_start).when(F.col("rn") > 0, F.col("timestamp_start"))} | {c: F.when(at.isNotNull(), at[c]).otherwise(F.col(c)) for c in moving}
    return x.filter(~(F.col("_shift") & right)).withColumns(moved).drop("_shift_partner")


def shifted_pairs(left: DataFrame, right: DataFrame, by: Sequence[str] = (), seconds: int = 60) -> DataFrame:
    """Pairs of single 5m keys that one side lacks each, shifted by at most `seconds`: by, instrument_id, timeframe, left_start, right_start."""
    x = _aligned(keyed_bars(left, right, None, by, seconds), by, seconds, rows=False).filter("_shift")
    return x.select(*by, "instrument_id", "timeframe", F.col("timestamp_start").alias("left_start"), F.col("own_start").alias("right_start"))


def compared_bars(left: DataFrame, right: DataFrame, config: BarComparison, expected: DataFrame | None = None, by: Sequence[str] = (), venue_where: Column | None = None, wanted: Column | None = None) -> DataFrame:
    """One row a key: its rows on both sides counted (ln, rn) and as they are (l, r, own_start), raw batches, and `marks` and `venue` of findings.

    Bit k of `marks` is a finding on METRIC_ORDER[k], described by findings_of(); bit k of `venue` says that it is the venue's. A key with
    several rows on a side is one duplicate finding; a key that a side lacks is one availability finding; else
    interval, session, adjustment, currency and then each number are compared. `by` names further key columns. With
    `venue_where` (a condition on the key), differences of venue metrics are the venue's only where it holds. Keys are expected by `expected` or
    by `wanted`, a condition on left rows.
    """
    t = config.tolerance
    compared = [m for m in NUMERIC_METRICS if m not in config.excluded_metrics]
    both = _aligned(keyed_bars(left, right, expected, by, t.alignment_seconds, wanted, [c for c in _ROW if c not in config.excluded_metrics]), by, t.alignment_seconds)

    def apart(name: str) -> Column:
        return F.col(f"l.{name}") != F.col(f"r.{name}")

    def far(m: str) -> Column:
        absolute, relative = (t.volume_absolute, t.volume_relative) if m == "volume" else (t.price_absolute, t.price_relative)
        return ~nearly_equal(F.col(f"l.{m}"), F.col(f"r.{m}"), absolute, relative)

    differs = {"interval_boundary": (F.col("timestamp_start") != F.col("own_start")) | apart("timestamp_end"), "session": apart("session"), "adjustment": apart("adjustment_state"), "currency": ~F.col("l.currency").eqNullSafe(F.col("r.currency"))}
    differs |= {m: far(m) for m in compared}
    found = reduce(Column.bitwiseOR, (F.when(c, _bit(m)).otherwise(F.lit(0)) for m, c in differs.items()))
    marks = F.when((F.col("ln") > 1) | (F.col("rn") > 1), _bit("duplicate_bar")).when((F.col("ln") == 0) | (F.col("rn") == 0), _bit("availability")).otherwise(found)
    sure = F.col("marks").bitwiseAND(_bit("interval_boundary", "session", "adjustment")) == 0
    venue = F.when(sure if venue_where is None else sure & venue_where, F.col("marks").bitwiseAND(_bit(*config.venue_metrics))).otherwise(F.lit(0))
    return both.select(*by, *BAR_KEY, "ln", "rn", "lraw", "rraw", "l", "r", "own_start", marks.alias("marks")).withColumn("venue", venue)


def _bit(*metrics: str) -> Column:
    """The bits of metrics in `marks`, as a literal."""
    return F.lit(sum(1 << METRIC_ORDER.index(m) for m in metrics))


def findings_of(compared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Findings: key, ordinal, metric, classification, left and right value (number or text), and raw batches of both sides.

    Marks become rows before they are described. Written with a list of findings and lambdas instead, Spark interprets the whole expression for each key.
    """
    own = {f.name for f in compared.schema["l"].dataType.fields}
    numbers = [m for m in NUMERIC_METRICS if m in own]
    k = F.col("ordinal")
    marked = [F.when(F.col("marks").bitwiseAND(_bit(m)) != 0, F.lit(i)) for i, m in enumerate(METRIC_ORDER)]
    rows = compared.withColumn("ordinal", F.explode(F.array(*marked))).filter(k.isNotNull())

    def chosen(values: dict[str, Column], kind: str) -> Column:
        found = F.lit(None).cast(kind)
        for m, value in reversed(values.items()):
            found = F.when(k == METRIC_ORDER.index(m), value).otherwise(found)
        return found

    def text(n: str, start: str) -> Column:
        counts = dict.fromkeys(("duplicate_bar", "availability"), F.col(f"{n}n").cast("string"))
        bounds = F.concat(F.lit("["), iso(F.col(start)), F.lit(", "), iso(F.col(f"{n}.timestamp_end")), F.lit(")"))
        return chosen(counts | {"interval_boundary": bounds, "session": F.col(f"{n}.session"), "adjustment": F.col(f"{n}.adjustment_state"), "currency": F.col(f"{n}.currency")}, "string")

    marks, timing = F.col("marks"), "timing_session_difference"
    number = (
        F.when(marks.bitwiseAND(_bit("adjustment")) != 0, "adjustment_difference").when(marks.bitwiseAND(_bit("interval_boundary", "session")) != 0, timing)
        .when(F.getbit("venue", k) == 1, "venue_feed_difference").otherwise("unresolved_discrepancy")
    )
    fixed = {"duplicate_bar": "likely_provider_issue", "availability": "missing_observation", "interval_boundary": timing, "session": timing, "adjustment": "adjustment_difference", "currency": "definitional_difference"}
    return rows.select(
        *by, *BAR_KEY, "ordinal", chosen({m: F.lit(m) for m in METRIC_ORDER}, "string").alias("metric"), chosen({m: F.lit(x) for m, x in fixed.items()} | dict.fromkeys(numbers, number), "string").alias("classification"),
        *(chosen({m: F.col(f"{n}.{m}") for m in numbers}, "double").alias(f"{side}_number") for n, side in (("l", "left"), ("r", "right"))),
        text("l", "timestamp_start").alias("left_text"), text("r", "own_start").alias("right_text"), F.col("lraw").alias("left_raw"), F.col("rraw").alias("right_raw"),
    )


def compare_bars(left: DataFrame, right: DataFrame, config: BarComparison, expected: DataFrame | None = None, by: Sequence[str] = (), venue_where: Column | None = None, wanted: Column | None = None) -> DataFrame:
    """The findings of compared_bars()."""
    return findings_of(compared_bars(left, right, config, expected, by, venue_where, wanted), by)


def coverage(left: DataFrame, right: DataFrame | None, expected: DataFrame, by: Sequence[str] = (), seconds: int = 60, wanted: Column | None = None) -> DataFrame:
    """Keyed bars with left_missing and right_missing: expected keys that a side lacks.

    A 5m key that a side lacks isn't missing if it is aligned with a key that the side has and nobody expects (several rows count too).
    """
    asked, five = F.col("wanted"), F.col("timeframe") == "5m"
    roles = {f"_{n}": (five & asked & (F.col(f"{n}n") == 0), five & ~asked & (F.col(f"{n}n") > 0)) for n in "lr"}
    x = _matched(keyed_bars(left, right, expected, by, seconds, wanted), by, seconds, roles)
    return x.withColumns({f"{side}_missing": asked & (F.col(f"{n}n") == 0) & ~F.col(f"_{n}") for n, side in (("l", "left"), ("r", "right"))}).drop(*roles)


def missing_expected(bars: DataFrame, expected: DataFrame, seconds: int = 60, by: Sequence[str] = ()) -> DataFrame:
    """Expected keys that the bars lack, less the aligned ones."""
    return coverage(bars, None, expected, by, seconds).filter("left_missing").select(*by, *BAR_KEY)


def provider_metrics(left: DataFrame, right: DataFrame, expected: DataFrame, providers: tuple[str, str], seconds: int = 60, wanted: Column | None = None) -> DataFrame:
    """One row a provider: observations, unique keys, surplus rows, expected and missing keys, all from one pass over the keys."""
    x = coverage(left, right, expected, (), seconds, wanted)
    totals = []
    for n, side in (("l", "left"), ("r", "right")):
        rows = F.col(f"{n}n")
        totals.append(
            F.struct(
                F.lit(providers["lr".index(n)]).alias("provider"), F.coalesce(F.sum(rows), F.lit(0)).alias("observations"), F.count_if(rows > 0).alias("unique_keys"), F.coalesce(F.sum(F.when(rows > 0, rows - 1)), F.lit(0)).alias("duplicates"),
                F.count_if("wanted").alias("expected"), F.count_if(f"{side}_missing").alias("missing"),
            )
        )
    return x.agg(F.array(*totals).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def ordered_findings(findings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """In key order, then in the fixed order of metrics."""
    return findings.orderBy(*by, *BAR_KEY, "ordinal")


def rendered_findings(findings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Ordered findings with both values as text, as a report shows them."""
    shown = {f"{s}_value": F.coalesce(F.col(f"{s}_text"), F.col(f"{s}_number").cast("string")) for s in ("left", "right")}
    return ordered_findings(findings.withColumns(shown), by).drop("left_text", "right_text", "left_number", "right_number")


def sanitized(findings: DataFrame) -> DataFrame:
    """What may leave a run: counts by metric and class, no values and no ids."""
    return findings.groupBy("metric", "classification").agg(F.count(F.lit(1)).alias("findings"))


def counts_by_class(findings: DataFrame) -> DataFrame:
    """(classification, findings) for every class, zeros included, in one pass."""
    counts = findings.agg(*(F.count_if(F.col("classification") == k).alias(k) for k in CLASSES))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("classification"), F.col(k).alias("findings")) for k in CLASSES))).alias("x")).select("x.*")


def counts_by_metric(findings: DataFrame) -> DataFrame:
    return findings.groupBy("metric").agg(F.count(F.lit(1)).alias("findings"))


def numeric_differences(findings: DataFrame) -> DataFrame:
    """For each numeric metric: how many findings have both numbers, and mean and largest absolute and relative difference."""
    a, b = F.col("left_number"), F.col("right_number")
    gap = F.abs(a - b)
    share = gap / F.nullif(F.greatest(F.abs(a), F.abs(b)), F.lit(0.0))
    both = findings.filter(a.isNotNull() & b.isNotNull())
    return both.groupBy("metric").agg(F.count(F.lit(1)).alias("findings"), F.avg(gap).alias("mean_absolute"), F.max(gap).alias("max_absolute"), F.avg(share).alias("mean_relative"), F.max(share).alias("max_relative"))


def compared_segments(left: DataFrame, right: DataFrame, providers: tuple[str, str], intraday: Column, expected: DataFrame | None = None, segment: str = "segment") -> DataFrame:
    """compared_bars() within segments: VWAP is never compared, and differences of volume are the venue's in intraday segments only."""
    config = BarComparison(*providers, venue_metrics=frozenset({"volume"}), excluded_metrics=frozenset({"vwap"}))
    return compared_bars(left, right, config, expected, (segment,), intraday)


def segment_rollup(compared: DataFrame, segment: str = "segment") -> DataFrame:
    """Per segment: rows of both sides, findings, those of duplicates and of the venue, and whether it passes (rows on both sides, no duplicates)."""
    x = compared.groupBy(segment).agg(
        F.sum("ln").alias("left_rows"), F.sum("rn").alias("right_rows"), F.sum(F.bit_count("marks")).cast("long").alias("findings"),
        F.count_if(F.col("marks") == _bit("duplicate_bar")).alias("duplicates"), F.sum(F.bit_count("venue")).cast("long").alias("venue"),
    )
    x = x.filter("left_rows > 0 OR right_rows > 0 OR findings > 0")
    return x.withColumn("passed", (F.col("left_rows") > 0) & (F.col("right_rows") > 0) & (F.col("duplicates") == 0))


def adjusted_behaviour(plain: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Rows matched on (instrument, start) between unadjusted and adjusted bars, and how many differ in any number."""
    on = ["instrument_id", "timestamp_start"]
    numbers = ("open", "high", "low", "close", "volume")
    same = F.lit(True)
    for m in numbers:
        same = same & F.col(f"p.{m}").eqNullSafe(F.col(f"a.{m}"))
    last = [x.groupBy(*on).agg(F.max_by(F.struct(*numbers), F.struct("raw_batch_id", *numbers)).alias("v")).select(*on, "v.*") for x in (plain, adjusted)]
    both = last[0].alias("p").join(last[1].alias("a"), on)
    return both.agg(F.count(F.lit(1)).alias("matched"), F.count_if(~same).alias("different"))
