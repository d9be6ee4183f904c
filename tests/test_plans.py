"""Plans that large data depends on."""

import pytest
from pyspark.sql import functions as F

from hirelens.operators import analyses, links, search
from hirelens.plans import star
from hirelens.schemas import CLEANED


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cleaned") / "t")
    spark.createDataFrame([("g", "t", "/l", "c", "e", *[None] * 9, ["s"])], CLEANED).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def tables(cleaned, tmp_path_factory):
    return star.load_star(cleaned, str(tmp_path_factory.mktemp("star")))


def test_columns_are_pruned_and_filters_pushed(cleaned):
    text = plan(analyses.high_salary(cleaned))
    assert "ReadSchema: struct<title:string,salary_normalized:bigint>" in text
    assert "GreaterThanOrEqual(salary_normalized,10000000)" in text
    text = plan(analyses.avg_salary_by_city(cleaned))
    assert "ReadSchema: struct<location:string,salary_normalized:bigint>" in text
    assert "partial_avg" in text


def test_top_k_does_not_sort_everything(cleaned):
    assert "TakeOrderedAndProject" in plan(analyses.top_paid_jobs(cleaned))
    assert "TakeOrderedAndProject" in plan(analyses.top_cities(cleaned))


def test_cube_expands_cells(cleaned):
    text = plan(analyses.market_cube(cleaned))
    # Read from the bottom: rows are aggregated before they are expanded.
    assert text.index("Expand") < text.index("partial_count(1)") < text.index("FileScan")


def test_rows_are_cut_before_the_shuffle(cleaned):
    text = plan(links.first_per_key(cleaned, ["title"]))
    assert text.index("Exchange") < text.index("row_number(), 1, Partial")
    text = plan(links.cap_per_group(cleaned.withColumn("n", F.hash("title")), ["n"]))
    assert text.count("row_number(), 500, Partial") == 2


def test_search_filters_reach_the_scan(tables):
    text = plan(search.search(tables, location="Huế", salary="5 - 10 triệu", skill="Python"))
    assert "EqualTo(location,Huế)" in text
    assert "GreaterThanOrEqual(salary_normalized,5000000)" in text and "LessThan(salary_normalized,10000000)" in text
    assert "EqualTo(name,Python)" in text


def test_bucketed_model_joins_without_shuffle(spark, tables, tmp_path):
    from hirelens.sources.tables import create_database, read_tables, save_tables

    create_database(spark, "bucketed", str(tmp_path / "db"))
    save_tables(tables, "bucketed", {"jobs": (4, "id"), "job_details": (4, "job_id"), "job_skills": (4, "job_id")})
    saved = read_tables(spark, "bucketed")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        details = saved["job_details"].withColumnRenamed("id", "detail_id")
        joined = saved["jobs"].join(details, F.col("id") == F.col("job_id"))
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
