"""The daily ingest as a stream over the raw layout."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.plans.daily import append_late, ingest_day, link_index
from hirelens.schemas import BLOCK
from hirelens.sources.blocks import LAYOUT


def read_stream(spark: SparkSession, raw: str, max_files: int | None = None, multi_line: bool = False) -> DataFrame:
    """Blocks of the raw layout as they arrive."""
    reader = spark.readStream.schema(T.StructType(BLOCK.fields + LAYOUT)).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(raw)


def ingest_stream(
    spark: SparkSession,
    raw: str,
    target: str,
    checkpoint: str,
    sources: Sequence[str],
    max_files: int | None = None,
    multi_line: bool = False,
    late_after: int = 3,
) -> None:
    """Ingest every day of which files arrived since the last run.

    The stream keeps no state but its progress. A day waits until every source delivered and is then worked out by the step of the
    daily batch, in the order of days. Files of a day that is already in are late if a later day is in, too, by `late_after` days or more:
    then only what they bring is added, the postings there staying as they are. Within that time the day is worked out again as a whole,
    as the batch would do it; 0 adds every file that comes after its day. A run that was cut off is repeated without harm.
    """
    def step(arrived: DataFrame, _: int) -> None:
        files = defaultdict(list)
        for row in arrived.select("crawl_date", "_file").distinct().collect():  # file names, as the stream's own log has them
            files[row.crawl_date].append(row._file)
        index = None
        for day in sorted(files):
            index = index or link_index(spark, target)
            last = index.last_day()
            if last is not None and index.has_day(day) and (last - day).days >= late_after:
                append_late(spark, files[day], raw, target, day, sources, multi_line)
            else:
                ingest_day(spark, raw, target, day, sources, multi_line)

    query = (
        read_stream(spark, raw, max_files, multi_line).select("crawl_date", F.col("_metadata.file_path").alias("_file")).writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
