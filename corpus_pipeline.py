"""Corpus pipeline: identify language, drop near copies and leaked passages, mask secrets, mix sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pumpline.llm.common import ready, save, table
from pumpline.llm.op2_langid import keep_identified
from pumpline.llm.op5_simhash import drop_near_copies
from pumpline.llm.op7_secrets import redact_live
from pumpline.llm.op8_mix import mixed_documents
from pumpline.llm.op9_decontaminate import drop_contaminated

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified language go."""
    return keep_identified(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_copies(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked in the text; every document stays."""
    return redact_live(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents that give words, with the words taken of each."""
    return mixed_documents(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mixing", mixing),
]

#: Naive Bayes, fingerprints and latent retrieval have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again before the next."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = save(spark, docs, f"stage-{name}")
    return docs
