"""Job postings derived from the order tables: one posting per order, every edge case included."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.functions.salary import currency_unit, normalize_salary
from hirelens.functions.text import parse_skill_list
from hirelens.plans.clean import clean_postings
from hirelens.plans.star import build_star, read_star, save_star
from hirelens.schemas import JOB_FIELDS
from hirelens.workspace import new_dir

CRAWL_DATE = "2025-10-07"
# Postings that a file holds at most, about, if it holds one JSON array.
FILE_POSTINGS = 50_000

# One text for both engines; only the tables and the date format differ.
VIEW = """
SELECT o.o_orderkey AS job_id,
  c.c_mktsegment AS grp,
  concat(CASE WHEN o.o_orderkey % 53 = 0 THEN '' ELSE concat('Job ', CAST(o.o_orderkey % 97 AS STRING)) END,
         CASE WHEN o.o_orderkey % 5 = 0 THEN ' (Remote)' ELSE '' END) AS title,
  concat('https://jobs.example.com/', CAST(o.o_orderkey % 9000 AS STRING)) AS link,
  CASE o.o_orderkey % 8
    WHEN 0 THEN 'Thoả thuận'
    WHEN 1 THEN concat(CAST(5 + o.o_custkey % 20 AS STRING), ' - ', CAST(10 + o.o_custkey % 40 AS STRING), ' triệu')
    WHEN 2 THEN concat('1,', CAST(100 + o.o_custkey % 800 AS STRING), ' - 2,500 USD')
    WHEN 3 THEN concat('Tới ', CAST(8 + o.o_custkey % 60 AS STRING), '.5 triệu')
    WHEN 4 THEN 'N/A'
    WHEN 5 THEN concat('$ ', CAST(300 + o.o_custkey % 3000 AS STRING))
    WHEN 6 THEN '15.000.000 VND' ELSE '' END AS salary,
  CASE o.o_orderkey % 11
    WHEN 0 THEN 'Hà Nội' WHEN 1 THEN 'Hồ Chí Minh' WHEN 2 THEN 'Hà Nội & Đà Nẵng'
    WHEN 3 THEN 'Hồ Chí Minh, Cần Thơ và 2 nơi khác' WHEN 4 THEN '' WHEN 5 THEN NULL
    ELSE n.n_name END AS location,
  CASE o.o_orderkey % 7
    WHEN 0 THEN 'Không yêu cầu kinh nghiệm' WHEN 1 THEN '0 năm' WHEN 2 THEN 'Dưới 1 năm'
    WHEN 3 THEN '00 năm' WHEN 4 THEN '' WHEN 5 THEN '0.5 năm'
    ELSE concat(CAST(1 + o.o_custkey % 5 AS STRING), ' năm') END AS experience,
  concat('Order ', o.o_orderstatus, ' ', o.o_orderpriority) AS description,
  CASE o.o_orderkey % 5
    WHEN 0 THEN '[Required] Python, Java và C# dev. ASP.NET, CI/CD!'
    WHEN 1 THEN 'React Native • SQL   MySQL? <b>Docker</b>'
    WHEN 2 THEN 'Thành thạo go, Golang; Git. Skill Required: Kafka'
    WHEN 3 THEN 'Kỹ năng: tiếng Anh'
    ELSE 'Spark và Hadoop [Preferred] JAVASCRIPT' END AS requirements,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE '- Laptop' END AS benefits,
  CASE WHEN o.o_orderkey % 4 = 0 THEN ' ' ELSE 'Thứ 2 - Thứ 6' END AS working_time,
  CASE o.o_orderkey % 4
    WHEN 0 THEN concat('Hạn nộp hồ sơ: ', @DATE@)
    WHEN 1 THEN CASE o.o_orderkey % 40
      WHEN 1 THEN 'Hết hạn trong 000003 ngày' WHEN 9 THEN 'Hết hạn trong 100000 ngày'
      ELSE concat('Hết hạn trong ', CAST(1 + o.o_custkey % 9 AS STRING),
                  CASE o.o_custkey % 3 WHEN 0 THEN ' ngày' WHEN 1 THEN ' tuần' ELSE ' tháng' END) END
    WHEN 2 THEN '31/02/2025' ELSE '' END AS deadline,
  CASE o.o_orderkey % 6
    WHEN 0 THEN 'Python, Django' WHEN 1 THEN 'java ,  SQL' WHEN 2 THEN ''
    WHEN 3 THEN 'MicroPython, C++' WHEN 4 THEN 'python,Python' ELSE 'Tiếng Anh, Git' END AS skills,
  CASE WHEN o.o_orderkey % 2 = 0 THEN 'board_a' ELSE 'board_b' END AS source,
  CAST(o.o_orderdate AS DATE) AS crawl_date
FROM @ORDERS@ o
JOIN @CUSTOMER@ c ON o.o_custkey = c.c_custkey
JOIN @NATION@ n ON c.c_nationkey = n.n_nationkey
"""


def duckdb_view() -> str:
    sql = VIEW.replace("@DATE@", "strftime(o.o_orderdate, '%d/%m/%Y')")
    for name in ("orders", "customer", "nation"):
        sql = sql.replace(f"@{name.upper()}@", name)
    return sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_stored: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that is derived and written once per session and then read like any other."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = new_dir(spark, name)
        build().write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def derive_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings with `job_id`, `group`, `source`, `crawl_date` and the skills as one text."""
    sql = VIEW.replace("@DATE@", "date_format(o.o_orderdate, 'dd/MM/yyyy')")
    for name in ("orders", "customer", "nation"):
        sql = sql.replace(f"@{name.upper()}@", f"{{{name}}}")
    postings = spark.sql(
        sql,
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )
    return postings.withColumnRenamed("grp", "group").withColumn("work_location_detail", F.col("location"))


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "postings", lambda: derive_postings(spark, sf_dir))


def flat_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings as the analyses take them."""
    def build() -> DataFrame:
        return (
            raw_postings(spark, sf_dir)
            .withColumn("salary_normalized", normalize_salary(F.col("salary")))
            .withColumn("currency_unit", currency_unit(F.col("salary_normalized")))
            .withColumnRenamed("salary", "salary_raw")
        )

    return stored(spark, sf_dir, "flat", build)


def cleaned_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned postings with their own skill lists and ids, as the relational model takes them."""
    def build() -> DataFrame:
        raw = raw_postings(spark, sf_dir)
        return clean_postings(raw, tagger=lambda _: parse_skill_list(F.col("skills")), keep=["job_id"])

    return stored(spark, sf_dir, "cleaned", build)


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The relational model of the cleaned postings."""
    key = (spark.sparkContext.applicationId, sf_dir, "model")
    if key not in _stored:
        path = new_dir(spark, "model")
        save_star(build_star(cleaned_postings(spark, sf_dir)), path)
        _stored[key] = path
    return read_star(spark, _stored[key])


def crawl_blocks(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """Blocks (crawl_date, source, group, jobs) as crawls would have left them.

    The crawl date is the first day of the period. A block takes neighbouring job ids, so it
    holds 500 postings at most, like a crawl of one group.
    """
    jobs = F.sort_array(F.collect_list(F.struct("job_id", *JOB_FIELDS)))
    return (
        raw_postings(spark, sf_dir)
        .withColumn("crawl_date", F.date_trunc(period, "crawl_date").cast("date"))
        .groupBy("crawl_date", "source", "group", F.floor(F.col("job_id") / 500).alias("part"))
        .agg(jobs.alias("jobs"))
        .select("crawl_date", "source", "group",
                F.transform("jobs", lambda j: F.struct(*[j[f].alias(f) for f in JOB_FIELDS])).alias("jobs"))
    )


def crawl_arrays(spark: SparkSession, sf_dir: str, period: str) -> DataFrame:
    """Files (crawl_date, source, value) as crawlers write them: the blocks of one run as one JSON array.

    Only one task can read such a file, and as a whole, so a source with many postings leaves several files for a date: blocks are
    dealt out by the hash of their postings, over a number of files that follows the number of postings.
    """
    files = -(-raw_postings(spark, sf_dir).count() // FILE_POSTINGS) or 1
    block = F.to_json(F.struct("group", "jobs"))
    return (
        crawl_blocks(spark, sf_dir, period)
        .groupBy("crawl_date", "source", F.pmod(F.xxhash64("group", "jobs"), F.lit(files)).alias("file"))
        .agg(F.array_join(F.collect_list(block), ",").alias("blocks"))
        .select("crawl_date", "source", F.concat(F.lit("["), F.col("blocks"), F.lit("]")).alias("value"))
    )


def save_arrays(arrays: DataFrame, root: str) -> None:
    """Write every array into a file of its own below the folder of its date and source."""
    arrays.write.option("maxRecordsPerFile", 1).partitionBy("crawl_date", "source").text(root)
