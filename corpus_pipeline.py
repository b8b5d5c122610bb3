"""Corpus pipeline: quality filter, line dedup, near duplicates, decontamination, mixing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over what the stage before it
kept; the result is written as Parquet below the shared scratch folder and read
again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``; null, empty and repeated rows have the results that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partwright.llm.common import read_table, written
from partwright.llm.decontaminate import drop_contaminated
from partwright.llm.line_dedup import line_dedup
from partwright.llm.mixing import mix_sources
from partwright.llm.ngram_join import near_distinct
from partwright.llm.quality import fit_quality, keep_quality

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return keep_quality(docs, model).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with repeated lines left in one of them only; n_chars follows the text."""
    kept = line_dedup(docs.select(*COLUMNS))
    chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", chars).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_distinct(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: one row per copy taken, sorted by position."""
    return mix_sources(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mix_sources", mix),
]

# The classifier, the similarity join and BM25 are beyond SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
