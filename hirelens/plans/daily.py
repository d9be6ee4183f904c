"""The daily batch: merge a day's sources, clean them, keep what is new, replace the day."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators.links import first_per_key, link_key
from hirelens.plans.clean import clean_postings
from hirelens.schemas import CLEANED, JOB_FIELDS
from hirelens.sources.blocks import CORRUPT, broken_layout, flatten, load_layout_files, read_layout
from hirelens.sources.link_index import KEY, LinkIndex
from hirelens.workspace import exists, stage, unstage

TARGET = T.StructType(
    [T.StructField("source", T.StringType())] + CLEANED.fields + [T.StructField("crawl_date", T.DateType())])


def read_target(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(TARGET).parquet(target)


def link_index(spark: SparkSession, target: str) -> LinkIndex:
    """The index of the links that each day of the target has, built now if the target is older than it."""
    index = LinkIndex(spark, f"{target}/_links")
    if exists(spark, target) and not exists(spark, index.path):
        index.build(read_target(spark, target))
    return index


def _order(postings: DataFrame) -> DataFrame:
    """One posting per link, with its key: the first in the order of source, file and place in the block."""
    return first_per_key(postings.withColumn(KEY, link_key()), ["source", "_file", "pos", *JOB_FIELDS], [KEY])


def _readable(blocks: DataFrame, day: datetime.date) -> None:
    broken = [row.file for row in broken_layout(blocks).select("file").limit(3).collect()]
    if broken:
        raise ValueError(f"unreadable on {day}: {', '.join(broken)}")


def _fresh(blocks: DataFrame, day: datetime.date) -> DataFrame:
    """One posting per link of the blocks, stored; the files are parsed once, and what is unreadable is counted on the way."""
    seen = Observation()
    watched = blocks.withColumn("_file", F.col("_metadata.file_path")).observe(
        seen, F.count_if(F.col(CORRUPT).isNotNull() & F.col("jobs").isNull()).alias("broken"))
    fresh = stage(_order(flatten(watched)), "fresh")
    if seen.get.get("broken") != 0:  # nothing is counted where Spark leaves out an empty scan
        try:
            _readable(blocks, day)
        except ValueError:
            unstage(fresh)
            raise
    return fresh


def ingest_day(
    spark: SparkSession, raw: str, target: str, day: datetime.date, sources: Sequence[str], multi_line: bool = False
) -> None:
    """Bring one day of the raw layout into the target table.

    Nothing is written unless every source delivered. Links that any other day brought for the same group are left out, so
    of copies on several days the one ingested first stays, also when a day comes late. Of several copies
    on the day the first one stays, in the order of source, file and place in the block. The day's rows replace what the target
    had for it, also if there are none now; running a day again gives the same result. `multi_line` is that
    of `read_layout`. Files that cannot be read raise an error that names some of them; `broken_layout` lists all.

    Of other days only those buckets of the link index are read that may hold a link of this one.
    """
    # The empty write only makes sure that the folder is there.
    spark.createDataFrame([], TARGET).write.mode("ignore").partitionBy("crawl_date").parquet(target)
    blocks = read_layout(spark, raw, multi_line).filter((F.col("crawl_date") == F.lit(day)) & F.col("source").isin(*sources))
    # Looks at one block of each source, where grouping the day would read all of it twice.
    if any(blocks.filter(F.col("source") == source).isEmpty() for source in sources):
        _readable(blocks, day)
        return
    fresh = _fresh(blocks, day)
    index = link_index(spark, target)
    postings = fresh.join(index.known(fresh, day), KEY, "left_anti")
    found = stage(clean_postings(postings, keep=["source", "crawl_date", KEY]), "day")
    # The index first: a link it has too early is only missing until this day is run again.
    index.put(day, found)
    if found.isEmpty():
        # A dynamic overwrite would leave the old rows of a day without new ones.
        found.drop("crawl_date", KEY).write.mode("overwrite").parquet(f"{target}/crawl_date={day.isoformat()}")
    else:
        (found.drop(KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("crawl_date").parquet(target))
    for df in (fresh, found):
        unstage(df)


def append_late(
    spark: SparkSession, files: Sequence[str], raw: str, target: str, day: datetime.date, sources: Sequence[str], multi_line: bool = False
) -> None:
    """Add what late files of a day bring that no day has yet, without reading the day's other files again.

    Postings that the target has stay, also where a late file has the same link in an earlier place. Of the target only the links
    of the day are read, so a run that was cut off can be repeated.
    """
    blocks = load_layout_files(spark, files, raw, multi_line).filter((F.col("crawl_date") == F.lit(day)) & F.col("source").isin(*sources))
    fresh = _fresh(blocks, day)
    index = link_index(spark, target)
    own = read_target(spark, target).filter(F.col("crawl_date") == F.lit(day)).select(link_key().alias(KEY))
    postings = fresh.join(own, KEY, "left_anti").join(index.known(fresh, day), KEY, "left_anti")
    found = stage(clean_postings(postings, keep=["source", "crawl_date", KEY]), "late")
    if not found.isEmpty():
        index.add(day, found)
        found.drop(KEY).write.mode("append").partitionBy("crawl_date").parquet(target)
    for df in (fresh, found):
        unstage(df)
