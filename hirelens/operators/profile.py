"""Profile of the raw data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.fixed_values import UNKNOWN


def overview(raw: DataFrame) -> DataFrame:
    """(source, level, postings, columns): one row per source with level 0, and one for all postings with level 1.

    Sources may be file names, so there can be any number of them. Postings without a source have a row of level 0.
    """
    return raw.rollup("source").agg(
        F.grouping_id().cast("int").alias("level"), F.count("*").alias("postings"), F.lit(", ".join(raw.columns)).alias("columns"))


def value_counts(df: DataFrame, value: Column, name: str) -> DataFrame:
    """(name, postings) for every value; null values are not counted."""
    return (
        df.select(value.alias(name))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("*").alias("postings"))
    )


def location_counts(raw: DataFrame) -> DataFrame:
    """Postings per location; a missing or empty location counts as unknown."""
    place = F.coalesce(F.nullif(F.col("location"), F.lit("")), F.lit(UNKNOWN))
    return value_counts(raw, place, "location")


def salary_counts(raw: DataFrame) -> DataFrame:
    """Postings per salary text; the empty text is a value, null is not."""
    return value_counts(raw, F.col("salary"), "salary")


def top_values(counts: DataFrame, k: int) -> DataFrame:
    """The k most frequent values; equal counts by value."""
    value = counts.columns[0]
    return counts.orderBy(F.desc("postings"), F.asc(value)).limit(k)
