"""Flat export of cleaned postings, and the JSON form of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.salary import digits_or_null
from hirelens.functions.text import join_skill_list, one_line
from hirelens.schemas import CLEANED, FLAT, FLAT_FIELDS

AS_IS = {"salary_normalized", "currency_unit", "skills"}


def flat_export(cleaned: DataFrame) -> DataFrame:
    """The 15 text columns of the export: one line per posting, empty text for null."""
    columns = {name: one_line(F.col(name).cast("string")) for name in FLAT_FIELDS if name not in AS_IS}
    columns["salary_normalized"] = F.coalesce(F.col("salary_normalized").cast("string"), F.lit(""))
    columns["currency_unit"] = F.coalesce("currency_unit", F.lit(""))
    columns["skills"] = one_line(join_skill_list(F.col("skills")))
    return cleaned.select(*[columns[name].alias(name) for name in FLAT_FIELDS])


def write_flat_csv(flat: DataFrame, path: str, mode: str = "errorifexists") -> None:
    flat.select(*FLAT_FIELDS).write.mode(mode).csv(
        path, header=True, quote='"', escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def read_flat_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The 15 columns as text, empty text where nothing is given.

    Own exports hold one posting per line, so their files can be split. Files from elsewhere
    with line ends inside quotes need `multi_line`.
    """
    rows = spark.read.schema(FLAT).csv(path, header=True, quote='"', escape='"', multiLine=multi_line)
    return rows.fillna("", FLAT_FIELDS)


def typed(flat: DataFrame) -> DataFrame:
    """Flat text rows with `salary_normalized` as bigint, as the analyses take them."""
    return flat.withColumn("salary_normalized", digits_or_null(F.col("salary_normalized")))


def write_cleaned_json(cleaned: DataFrame, path: str, mode: str = "errorifexists") -> None:
    cleaned.select(*CLEANED.names).write.mode(mode).option("ignoreNullFields", False).json(path)


def read_cleaned_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CLEANED).json(path)
