"""What the operators share: text patterns, null-safe keys and intermediate tables."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.workspace import new_dir

#: A run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: A run of letters, digits and characters beyond ASCII, in text whose A-Z are lower-cased.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, pattern: str = WORD) -> Column:
    """The words of a text in order; none for a null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; null for a null id."""
    return F.crc32(doc_id.cast("string")) % by


def code(doc_id: int | None) -> str | None:
    """The id as the text that `remainder` hashes, for Python code."""
    return None if doc_id is None else str(doc_id)


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Equality on columns that may be null."""
    condition = left[names[0]].eqNullSafe(right[names[0]])
    for name in names[1:]:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


#: Spark then deletes the shuffle files of a query at its end, and not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables of one run, in a folder under `spark.checkpoint.dir`.

    `keep` writes a frame and reads it back: this cuts the lineage, and the table outlives any
    executor. `drop` removes single tables as soon as nothing needs them, `close` all but the named. What a returned
    frame still reads stays, since only its user knows when it is done.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.names = spark, new_dir(spark, label), set()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        self.names.add(name)
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def finish(self, df: DataFrame) -> DataFrame:
        """Keep the result and remove everything else."""
        result = self.keep(df, "result")
        self.close("result")
        return result

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.names.discard(name)

    def close(self, *but: str) -> None:
        self.drop(*(self.names - set(but)))
