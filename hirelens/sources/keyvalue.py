"""Tab-separated key/value lines, the form in which an analysis is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.text import strip


def write_key_values(df: DataFrame, path: str) -> None:
    """Write the first two columns as `key<TAB>value` lines, replacing what the path held."""
    key, value = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns[:2])
    df.select(F.concat(key, F.lit("\t"), value).alias("value")).write.mode("overwrite").text(path)


def parse_key_values(lines: DataFrame) -> DataFrame:
    """(key, value, number) of the lines with exactly two parts; `number` if the value is one."""
    parts = F.split(strip(F.col("value")), "\t")
    return (
        lines.select(parts.alias("parts"))
        .filter(F.size("parts") == 2)
        .select(F.col("parts")[0].alias("key"), F.col("parts")[1].alias("value"))
        .withColumn("number", F.col("value").try_cast("double"))
    )


def read_key_values(spark: SparkSession, path: str) -> DataFrame:
    """All parts of a stored analysis, not only the first file."""
    return parse_key_values(spark.read.text(path))
