"""Corpus pipeline: stages applied to ``documents`` one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.llm import langid, linedup, minhash, packing
from cohortflow.llm.common import stage, table
from cohortflow.llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known stay."""
    return langid.keep_accepted(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, and documents that consist of nothing else; ``n_chars`` is counted anew."""
    cleaned = linedup.drop_recurring_lines(docs)
    left = (F.col("n_dropped") == 0) | (F.trim(F.col("text")) != "")
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into sequences."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", near_duplicate_stage),
    ("packing", packing_stage),
]

#: No stage but the last can be put in SQL; tests compare the whole with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back as the next stage's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
