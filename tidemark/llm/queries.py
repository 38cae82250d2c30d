"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, conversation_repair, hard_negatives, html_extract, language_id, ogg_media, packing, quality_cascade, simhash, substring_dedup, token_counts, url_filter, word_bpe
from tidemark.llm.common import ship_package

MODULES = {
    "op1_html_extract": html_extract,
    "op2_ogg_media": ogg_media,
    "op3_substring_dedup": substring_dedup,
    "op4_language_id": language_id,
    "op5_url_filter": url_filter,
    "op6_quality_cascade": quality_cascade,
    "op7_simhash": simhash,
    "op8_packing": packing,
    "op9_byte_bpe": byte_bpe,
    "op10_token_counts": token_counts,
    "op11_word_bpe": word_bpe,
    "op12_hard_negatives": hard_negatives,
    "op13_conversation_repair": conversation_repair,
}


def _shipped(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(m.query) for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: m.SQL for name, m in MODULES.items() if hasattr(m, "SQL")}
