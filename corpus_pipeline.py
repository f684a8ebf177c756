"""The corpus pipeline: quality rules, language, near duplicates, repeated passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.

Defined results: documents with a null or empty text fail the base rules and go; repeated rows and null ids are judged each
by the first two stages, and are one document of their group in the third, which keeps the smallest id (a null one only
where the whole group has no id); null languages and labels are never learned from; texts of any length are handled
whole; columns that ``documents`` does not have are carried up to packing; an empty table makes no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterlens.llm import langid, packing, quality, simhash, suffix
from rosterlens.llm.common import table
from rosterlens.sources.staging import scratch, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or that the classifier rejects."""
    return quality.filter_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is unknown or uncertain."""
    return langid.filter_language(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return simhash.deduplicate(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what repeats an earlier passage out of the texts."""
    return suffix.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place all documents in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language", language),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", pack),
]

#: The stages learn models and tokenize, which SQL cannot express; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. Each stage's output stays in the shared folder, its own tables go once it is written."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        with scratch(spark) as folder:
            docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"), folder)
    return docs
