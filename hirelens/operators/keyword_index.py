"""Posting lists for keyword search: which jobs hold which three characters in a row.

A keyword's literal runs give the trigrams that a text must have, so only jobs on all their lists are read; whether the text
really matches is then decided by the pattern itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.text import bind
from hirelens.operators.search import Tables, search_keyword

FIELDS = ["title", "description"]


def trigrams(text: Column) -> Column:
    """The different runs of three characters of the text in lower case."""
    def runs(chars: Column) -> Column:
        places = F.slice(F.sequence(F.lit(1), F.size(chars)), F.lit(1), F.greatest(F.size(chars) - 2, F.lit(0)))
        return F.array_distinct(F.transform(places, lambda i: F.concat(F.get(chars, i - 1), F.get(chars, i), F.get(chars, i + 1))))

    return bind(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("(?s)."), F.lit(0)), runs)


def build_index(tables: Tables, path: str, files: int = 32) -> None:
    """Write (gram, id, field) of the titles and descriptions of all jobs, sorted, so that a search reads the row groups of its grams.

    Ranges are cut by gram and id, since some grams stand in most texts.
    """
    texts = tables["jobs"].select("id", "title").join(tables["job_details"].select(F.col("job_id").alias("id"), "description"), "id", "left")
    parts = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in FIELDS]))
    rows = texts.select("id", parts.alias("p")).select("id", "p.field", F.explode(trigrams(F.col("p.text"))).alias("gram"))
    rows.select("gram", "id", "field").repartitionByRange(files, "gram", "id").sortWithinPartitions("gram", "id").write.mode("overwrite").parquet(path)


def keyword_grams(spark: SparkSession, keyword: str) -> list[str]:
    """The trigrams that every text has which holds the keyword; none if it has no three literal characters in a row."""
    runs = spark.createDataFrame([(run,) for run in keyword.lower().replace("_", "%").split("%")], "run string")
    return sorted(r.gram for r in runs.select(F.explode(trigrams(F.col("run"))).alias("gram")).distinct().collect())


def candidates(index: DataFrame, grams: list[str]) -> DataFrame:
    """Ids of the jobs of which one field has all the grams."""
    met = index.filter(F.col("gram").isin(grams)).groupBy("id", "field").agg(F.count(F.lit(1)).alias("n"))
    return met.filter(F.col("n") == len(grams)).select("id").distinct()


def jobs_with_keyword(tables: Tables, path: str, keyword: str) -> DataFrame:
    """(id, title) of the jobs whose title or description holds the keyword; `%` and `_` are wildcards in it.

    Without three literal characters in a row all texts are read.
    """
    spark = tables["jobs"].sparkSession
    jobs, details = tables["jobs"].select("id", "title"), tables["job_details"].select(F.col("job_id").alias("id"), "description")
    grams = keyword_grams(spark, keyword)
    if grams:
        found = candidates(spark.read.parquet(path), grams)
        jobs, details = jobs.join(found, "id", "left_semi"), details.join(found, "id", "left_semi")
    return search_keyword(jobs.join(details, "id", "left"), keyword).select("id", "title")
