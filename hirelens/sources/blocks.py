"""Raw crawl files: arrays of blocks, each with the postings found for one group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.schemas import BLOCK, JOB, JOB_FIELDS

CORRUPT = "_corrupt_record"
# Partition columns of the day layout: <root>/crawl_date=.../source=.../
LAYOUT = [T.StructField("crawl_date", T.DateType()), T.StructField("source", T.StringType())]


def load_blocks(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """The blocks of the files, with partition columns if the folders have any.

    `multi_line` reads files that hold one JSON array each. Without it every line is a block or
    an array of blocks, and large files can be split between tasks.
    """
    schema = T.StructType(BLOCK.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths, multiLine=multi_line)


def flatten(blocks: DataFrame, drifted_key: bool = False) -> DataFrame:
    """One row per posting: group, source, `pos` in the block, the fields of the posting.

    Blocks without postings and files that cannot be read give no row. `drifted_key` also takes
    the group from the old key. `source` is the partition column, else the name of the file.
    """
    group = F.coalesce("group", "skill") if drifted_key else F.col("group")
    source = F.col("source") if "source" in blocks.columns else F.col("_metadata.file_name")
    rest = [c for c in blocks.columns if c not in (*BLOCK.names, CORRUPT, "source")]
    return (
        blocks.select(*rest, group.alias("group"), source.alias("source"), F.posexplode("jobs").alias("pos", "job"))
        .select(*rest, "group", "source", "pos", *[f"job.{name}" for name in JOB_FIELDS])
    )


def read_blocks(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True, drifted_key: bool = False
) -> DataFrame:
    return flatten(load_blocks(spark, paths, multi_line), drifted_key)


def broken_blocks(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """(file, record) of everything `read_blocks` had to leave out as unreadable."""
    return (
        load_blocks(spark, paths, multi_line)
        .select(F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record"), "jobs")
        .filter(F.col("record").isNotNull() & F.col("jobs").isNull())
        .drop("jobs")
    )


def read_ungrouped(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Files that hold plain postings without blocks; `group` is null."""
    jobs = spark.read.schema(JOB).json(paths, multiLine=multi_line)
    return jobs.select(F.lit(None).cast("string").alias("group"), F.col("_metadata.file_name").alias("source"),
                       *JOB_FIELDS)


def _by_day(blocks: DataFrame) -> DataFrame:
    """Blocks gathered by target folder into files of even size; large folders get several tasks."""
    return blocks.hint("rebalance", "crawl_date", "source")


def append_blocks(blocks: DataFrame, root: str) -> None:
    """Add blocks (crawl_date, source, group, jobs) to the day layout, one block per line.

    Spark commits the whole job or nothing, so readers never meet a half-written file.
    """
    _by_day(blocks).write.mode("append").partitionBy("crawl_date", "source").json(root)


def replace_days(blocks: DataFrame, root: str) -> None:
    """Like `append_blocks`, but the partitions that `blocks` touches are replaced."""
    (_by_day(blocks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("crawl_date", "source").json(root))


def read_layout(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """All blocks of the day layout; a filter on crawl_date or source reads only those folders.

    `multi_line` reads files of one indented JSON array each, as crawlers write them. What cannot be read has null
    fields and its text in `CORRUPT`, see `broken_layout`.
    """
    return load_layout_files(spark, [root], root, multi_line)


def load_layout_files(spark: SparkSession, files: Sequence[str], root: str, multi_line: bool = False) -> DataFrame:
    """The same for some files or folders of the layout below `root`."""
    schema = T.StructType(BLOCK.fields + [T.StructField(CORRUPT, T.StringType())] + LAYOUT)
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("basePath", root)
    return reader.json(list(files), multiLine=multi_line)


def broken_layout(layout: DataFrame) -> DataFrame:
    """(crawl_date, source, file, record) of everything in `read_layout` that is no block."""
    return (
        layout.select("crawl_date", "source", F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record"), "jobs")
        .filter(F.col("record").isNotNull() & F.col("jobs").isNull())
        .drop("jobs")
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name, null where a frame has no such column."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def complete_days(blocks: DataFrame, sources: Sequence[str]) -> DataFrame:
    """The blocks of the named sources, for the days on which all of them delivered."""
    wanted = blocks.filter(F.col("source").isin(*sources))
    full = (
        wanted.select("crawl_date", "source").distinct()
        .groupBy("crawl_date").agg(F.count("*").alias("n"))
        .filter(F.col("n") == len(sources))
    )
    return wanted.join(full, "crawl_date", "left_semi")


def merged_totals(blocks: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Per complete day: blocks of each source, blocks in total, postings in total."""
    counts = [F.count_if(F.col("source") == s).alias(f"blocks_{s}") for s in sources]
    return (
        blocks.filter(F.col("source").isin(*sources))
        .groupBy("crawl_date")
        .agg(*counts, F.count("*").alias("total_blocks"), F.sum(F.size("jobs")).alias("total_jobs"))
        .filter(" AND ".join(f"`blocks_{s}` > 0" for s in sources))
    )
