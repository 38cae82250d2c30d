"""Corpus preparation as five written stages.

Each stage works on all that its predecessor kept: language identification drops texts whose words have no clear language, the
quality cascade drops what a rule rejects, near-dedup keeps one document of each group of near copies (Jaccard similarity of
five-word shingles 0.8 or more), substring dedup cuts repeated passages out of the texts, and packing cuts the documents into
sequences of tokens.

A table without documents goes through all stages as an empty one. Rows with null text leave in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, packing, quality_cascade, similar_texts, substring_dedup
from tidemark.llm.common import own_columns, scratch_path, ship_package, unused

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text stays if the mean of its words' largest marginals is at least this, whatever the shares of its languages.
LEAST_CERTAINTY = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    certainty = unused("_certainty", docs)
    found = language_id.predict(docs, language_id.fit(docs), certainty=certainty)
    return own_columns(found.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col(certainty) >= LEAST_CERTAINTY)), docs.columns, "lang_pred", "score")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = quality_cascade.judged(docs).filter(F.col("rejected_by").isNull())
    return own_columns(found, docs.columns, "rejected_by")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return similar_texts.keep_one(docs).select(*docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; n_chars follows the text."""
    ship_package(spark)
    left = substring_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast("long"))
    return own_columns(left, docs.columns, "n_words", "n_removed")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]
#: A trained model decides in the first stage, so no SQL gives the rows; tests hold the first stage by its parts and each other one against brute force, SQL or a library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written to the shared folder and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}-{name}")
    return docs
