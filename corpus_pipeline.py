"""Documents to training mix: quality rules, near duplicates, benchmark passages, personal data, source weights.

Every stage takes (spark, docs, sf_dir) and returns a frame. `run` writes each result as Parquet and reads it
again for the next one, so every stage works on all that its predecessor kept. All stages but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirelens.llm import decontamination, mixing, personal_data, quality_rules, simhash
from hirelens.llm.base import Scratch


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no certified rule rejects."""
    return quality_rules.filter_documents(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return simhash.representatives(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return personal_data.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often it takes each."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("personal_data", masked),
    ("mixing", mixed),
]

#: Near duplicates and span classification have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
