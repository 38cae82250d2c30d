"""Windows of a study: which instruments are asked for over which times, from a table of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = "label string, segment string, universe string, timeframe string, adjustment_state string, start timestamp, end timestamp, session_dates array<date>"


def study_windows(rules: DataFrame, sessions: DataFrame) -> DataFrame:
    """One window a rule with bounds, or one for each session date of a rule: label, segment, universe, timeframe, adjustment_state, start, end.

    rules have the columns of RULES. A rule with session dates takes each session's own bounds, and the date goes into the label. A
    date without a session, a rule with neither bounds nor dates or with both, and an empty interval fail the query when it runs.
    """
    dated = F.col("session_dates").isNotNull()
    fixed = F.col("start").isNotNull() & F.col("end").isNotNull()
    x = rules.withColumn("session_date", F.explode(F.when(dated, F.col("session_dates")).otherwise(F.array(F.lit(None).cast("date")))))
    known = sessions.select("session_date", F.col("start").alias("_open"), F.col("end").alias("_close"))
    x = x.join(F.broadcast(known), "session_date", "left")
    start, end = F.when(dated, F.col("_open")).otherwise(F.col("start")), F.when(dated, F.col("_close")).otherwise(F.col("end"))
    label = F.when(dated, F.concat("label", F.lit("-"), F.date_format("session_date", "yyyy-MM-dd"))).otherwise(F.col("label"))

    def failed(text: str, value: Column) -> Column:
        return F.raise_error(F.concat(F.lit(text), value)).cast("string")

    checked = (
        F.when(dated == fixed, failed("a rule needs bounds or session dates: ", F.col("label")))
        .when(dated & F.col("_open").isNull(), failed("no session on a study date: ", label))
        .when(start >= end, failed("an empty window: ", label))
        .otherwise(label)
    )
    return x.select(checked.alias("label"), "segment", "universe", "timeframe", "adjustment_state", start.alias("start"), end.alias("end"))


def window_targets(windows: DataFrame, targets: DataFrame) -> DataFrame:
    """Each window with each target of its universe (targets: universe, symbol, instrument_id), an equi-join; a window without targets leaves."""
    return windows.join(targets, "universe")


def target_counts(windows: DataFrame, targets: DataFrame) -> DataFrame:
    """windows with `targets` and `symbols`, the rows and distinct symbols that window_targets() gives each; a window without targets leaves.

    Targets are counted by universe before they meet the windows, so no target is repeated for each window of its universe and no
    universe is one task. Windows and universes are a study's own lists.
    """
    listed = targets.groupBy("universe", "symbol").agg(F.count(F.lit(1)).alias("_n"))
    counts = listed.groupBy("universe").agg(F.sum("_n").alias("targets"), F.count("symbol").alias("symbols"))
    return windows.join(counts, "universe")
