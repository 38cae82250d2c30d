"""Market time: UTC instants, New York sessions and wire formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ZONE = "America/New_York"


def new_york_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, ZONE))


def session_open(day: Column) -> Column:
    """09:30 in New York as an instant."""
    return F.make_timestamp(F.year(day), F.month(day), F.day(day), F.lit(9), F.lit(30), F.lit(0), F.lit(ZONE))


def session_close(day: Column) -> Column:
    """16:00 in New York as an instant."""
    return F.make_timestamp(F.year(day), F.month(day), F.day(day), F.lit(16), F.lit(0), F.lit(0), F.lit(ZONE))


def weekdays(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """One row for each Monday to Friday in [start, end) of every row, as session_date."""
    days = ranges.filter(F.col(start) < F.col(end)).withColumn("session_date", F.explode(F.sequence(F.col(start), F.date_sub(F.col(end), 1))))
    return days.filter(F.weekday("session_date") < 5)


def sessions(days: DataFrame, closed: DataFrame | None = None, extra: DataFrame | None = None, early: DataFrame | None = None) -> DataFrame:
    """Session bounds (session_date, start, end) of weekdays less closed days plus extra ones; `early` has (session_date, close)."""
    found = days.select("session_date")
    if closed is not None:
        found = found.join(closed.select("session_date"), "session_date", "left_anti")
    if extra is not None:
        found = found.unionByName(extra.select("session_date"))
    found = found.distinct()
    end = session_close(F.col("session_date"))
    if early is not None:
        found = found.join(early.select("session_date", F.col("close").alias("_early")), "session_date", "left")
        end = F.coalesce("_early", end)
    return found.select("session_date", session_open(F.col("session_date")).alias("start"), end.alias("end"))


def expected_keys(windows: DataFrame, sessions_: DataFrame) -> DataFrame:
    """Expected starts of every window: the session's for 1d, each full five minutes of the overlap for 5m.

    windows: segment, instrument_id, timeframe, start, end (instants). Windows meet sessions by day, an equi-join. Sessions have a
    row a calendar day, so they are the side that is broadcast; days of windows are many more than Spark's estimate, which
    knows the windows only.
    """
    w = windows.select("segment", "instrument_id", "timeframe", F.col("start").alias("ws"), F.col("end").alias("we"))
    w = w.withColumn("session_date", F.explode(F.sequence(F.to_date(F.from_utc_timestamp("ws", ZONE)), F.to_date(F.from_utc_timestamp("we", ZONE)))))
    x = w.join(F.broadcast(sessions_), "session_date")
    daily = x.filter((F.col("timeframe") == "1d") & (F.col("ws") <= F.col("start")) & (F.col("start") < F.col("we")) & (F.col("end") <= F.col("we")))
    a, b = F.greatest("ws", "start"), F.least("we", "end")
    five = F.expr("INTERVAL '5' MINUTE")
    intraday = x.filter(F.col("timeframe") == "5m").withColumns({"a": a, "b": b}).filter(F.col("b") >= F.col("a") + five)
    intraday = intraday.withColumn("timestamp_start", F.explode(F.sequence(F.col("a"), F.col("b") - five, five)))
    out = ("segment", "instrument_id", "timeframe", "timestamp_start")
    return daily.withColumn("timestamp_start", F.col("start")).select(*out).unionByName(intraday.select(*out))


def ordered_keys(keys: DataFrame) -> DataFrame:
    """Expected keys in order of segment, instrument, timeframe and start."""
    return keys.orderBy("segment", "instrument_id", "timeframe", "timestamp_start")


def misaligned_windows(windows: DataFrame, sessions_: DataFrame) -> DataFrame:
    """Five-minute windows whose overlap with a session starts off its five-minute grid."""
    w = windows.filter("timeframe = '5m'").withColumn("session_date", F.explode(F.sequence(F.to_date(F.from_utc_timestamp("start", ZONE)), F.to_date(F.from_utc_timestamp("end", ZONE)))))
    s = sessions_.select("session_date", F.col("start").alias("s"), F.col("end").alias("e"))
    x = w.join(F.broadcast(s), "session_date").filter((F.greatest("start", "s") < F.least("end", "e")))
    return x.filter((F.unix_micros(F.greatest("start", "s")) - F.unix_micros("s")) % 300_000_000 != 0)


def overlapping_keys(keys: DataFrame) -> DataFrame:
    """Expected keys that occur more than once within a segment."""
    return keys.groupBy("segment", "instrument_id", "timeframe", "timestamp_start").count().filter("count > 1")


def points_possible(start: Column, end: Column, timeframe: Column) -> Column:
    """The most observations a request can return: one a day, or one each five minutes, both ends counted."""
    seconds = F.when(timeframe == "1d", 86_400).otherwise(300)
    return (F.ceil((F.unix_micros(end) - F.unix_micros(start)) / (seconds * 1_000_000.0)) + 1).cast("long")


def wire_bounds(requests: DataFrame, limit: int = 5000) -> DataFrame:
    """How three wire formats state [start, end): epoch milliseconds, RFC 3339 with an inclusive end, and naive UTC text."""
    start, end = F.col("start"), F.col("end")
    last = end - F.expr("INTERVAL '1' MICROSECOND")
    points = points_possible(start, end, F.col("timeframe"))
    return requests.withColumns(
        {
            "start_ms": F.ceil(F.unix_micros(start) / 1000).cast("long"),
            "end_ms": F.floor(F.unix_micros(last) / 1000).cast("long"),
            "start_rfc": F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            "end_rfc": F.date_format(last, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
            "start_naive": F.date_format(start, "yyyy-MM-dd HH:mm:ss"),
            "end_naive": F.date_format(last, "yyyy-MM-dd HH:mm:ss"),
            "points": points,
            "too_many": points > limit,
        }
    )


def credit_windows(log: DataFrame, by: str, ts: str, cost: str, total_limit: int, limit: int = 8, block_seconds: int = 600) -> DataFrame:
    """Rolling 60-second credit use (events 60 seconds old no longer count), the running total, and whether a limit is passed.

    Time is cut into blocks of a minute at least. Blocks are summed first and the sums run up over a provider's few blocks;
    then each block adds up its own events, with copies of the events of the minute before it. So a provider's events spread
    over as many tasks as it has blocks.
    """
    size, minute = max(60, block_seconds) * 1_000_000, 59_999_999
    us, home, block = F.col("_us"), F.col("_home"), F.col("_block")
    x = log.withColumn("_us", F.unix_micros(ts)).withColumn("_home", us - F.pmod(us, F.lit(size)))
    sums = x.groupBy(F.col(by).alias("_by"), home.alias("_at")).agg(F.sum(cost).alias("_sum"))
    earlier = F.sum("_sum").over(W.partitionBy("_by").orderBy("_at").rowsBetween(W.unboundedPreceding, -1))
    before = sums.select("_by", "_at", F.coalesce(earlier, F.lit(0)).alias("_before"))
    copies = x.withColumn("_block", F.explode(F.array_compact(F.array(home, F.when(home + size - us <= minute, home + size)))))
    ordered = W.partitionBy(by, "_block").orderBy("_us")
    own = F.sum(F.when(block == home, F.col(cost))).over(ordered.rangeBetween(W.unboundedPreceding, 0))
    used = copies.withColumns({"used_60s": F.sum(cost).over(ordered.rangeBetween(-minute, 0)), "_own": own}).filter(block == home)
    used = used.join(before, used[by].eqNullSafe(before["_by"]) & (used["_home"] == before["_at"]), "left").withColumn("used_total", F.col("_before") + F.col("_own"))
    return used.withColumns({"over_rate": F.col("used_60s") > limit, "over_total": F.col("used_total") > total_limit}).select(*log.columns, "used_60s", "used_total", "over_rate", "over_total")
