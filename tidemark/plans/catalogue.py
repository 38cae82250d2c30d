"""Queries over the engine's own operators, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import action_queries, bar_queries, evidence_queries, normalize_queries, pipeline_queries, raw_queries, reconcile_queries

_FAMILIES = (bar_queries, reconcile_queries, action_queries, raw_queries, normalize_queries, pipeline_queries, evidence_queries)


def _in_utc(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _in_utc(run) for family in _FAMILIES for name, (run, _) in family.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for family in _FAMILIES for name, (_, sql) in family.QUERIES.items() if sql}
