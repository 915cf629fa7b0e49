"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Rows
that a stage rejects are gone for all later ones. Null and empty texts, repeated rows and empty tables are handled as
the operators say. SQL cannot express the fitted rules, the sort or the encoding, so there is no ``ORACLE_SQL``; tests
hold the stages against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwarden.llm import decontaminate, near_dedup, piece_coding, quality_rules, suffix_dedup
from sparkwarden.llm.common import table
from sparkwarden.session import discard, materialize

# Least similarity of near duplicates here; the 85 of ``op7_near_dedup`` binds that query only.
PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return near_dedup.keep_first(docs, percent=PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that occur elsewhere too; ``n_chars`` follows the text."""
    cleaned = suffix_dedup.clean(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, their number and digest, and whether they decode to the text."""
    return piece_coding.coded(docs, ["doc_id"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontaminate", contamination),
    ("piece_coding", coding),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        kept = materialize(stage(spark, docs, sf_dir), name)
        discard(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
