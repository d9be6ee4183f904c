"""Search page by page, and the posting lists of keywords."""

import datetime

import pytest
from pyspark.sql import functions as F

from hirelens.operators import keyword_index, search
from hirelens.plans import star
from hirelens.schemas import CLEANED
from test_model import posting

WORDS = ["Flask", "100% đẹp", "Order of High", "a_b", "naïve É", "xy", "", None, "😀😀😀 smile", "it's % here"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    days = [None, datetime.date(2025, 10, 7), datetime.date(2025, 10, 8)]
    rows = [posting(["Web", "Data"][i % 2], f"Job {i} {WORDS[i % 5]}", ["Python", f"s{i}"][: i % 3], deadline=days[i % 3],
                    salary_normalized=1_000_000 * i, location="Huế", description=WORDS[i % len(WORDS)]) for i in range(60)]
    return star.load_star(spark.createDataFrame(rows, CLEANED), str(tmp_path_factory.mktemp("star")))


@pytest.fixture(scope="module")
def index(tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "grams")
    keyword_index.build_index(tables, path, files=4)
    return path


@pytest.mark.parametrize("criteria", [{}, {"group": "Web"}, {"keyword": "flask"}, {"skill": "Python", "location": "Huế"}])
def test_pages_join_to_the_whole_result(tables, criteria):
    whole = [tuple(r) for r in search.search(tables, **criteria).collect()]
    pages, after = [], None
    while page := search.search_page(tables, 7, after, **criteria).collect():
        pages += [tuple(r) for r in page]
        after = (page[-1].deadline, page[-1].id)
    assert pages == whole and len(whole) > 7


def test_a_page_sorts_no_texts(tables):
    found = search.search_ids(tables, group="Web", location="Huế").orderBy(F.asc_nulls_first("deadline"), "id").limit(5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "description" not in plan and "requirements" not in plan


@pytest.mark.parametrize("keyword", ["FLASK", "100% Đ", "order%high", "rde_ o", "xy", "%", "naïve é", "😀😀😀", "none of it", "it's %", "a_b", "Job 1"])
def test_lists_find_what_the_pattern_finds(tables, index, keyword):
    texts = tables["jobs"].select("id", "title").join(tables["job_details"].select(F.col("job_id").alias("id"), "description"), "id", "left")
    expected = sorted(r.id for r in search.search_keyword(texts, keyword).collect())
    assert sorted(r.id for r in keyword_index.jobs_with_keyword(tables, index, keyword).collect()) == expected


def test_only_candidates_are_compared(spark, tables, index):
    lists = spark.read.parquet(index)
    grams = keyword_index.keyword_grams(spark, "Order%HIGH")
    assert grams == sorted({"ord", "rde", "der", "hig", "igh"})
    found = keyword_index.candidates(lists, grams)
    assert 0 < found.count() <= 18
    assert "PushedFilters: [In(gram" in found._jdf.queryExecution().executedPlan().toString()
    assert keyword_index.keyword_grams(spark, "a_b%cd") == []


def test_trigrams(evaluate):
    assert evaluate(keyword_index.trigrams, ["ABCd", "ab", "", None, "aaaa", "é\n😀x"]) == [["abc", "bcd"], [], [], [], ["aaa"], ["é\n😀", "\n😀x"]]


@pytest.mark.parametrize("criteria", [{}, {"group": "Web"}])
def test_many_jobs_are_merged_and_sent_to_no_task(tables, monkeypatch, criteria):
    """By their sizes in files the texts and ids of all jobs looked small enough to go to every task."""
    expected = [tuple(r) for r in search.search(tables, **criteria).collect()]
    monkeypatch.setattr(search, "FEW_JOBS", 5, raising=False)
    found = search.search(tables, **criteria)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "LeftOuter, BuildRight" not in plan
    assert [tuple(r) for r in found.collect()] == expected and len(expected) > 5


def test_a_model_sends_its_names_to_every_task_and_not_the_postings(spark, tmp_path):
    rows = [posting(["Web", "Data"][i % 2], f"Job {i}", ["Python", f"s{i % 7}"], location="Huế", description="x" * 50) for i in range(500)]
    spark.createDataFrame(rows, CLEANED).coalesce(1).write.parquet(str(tmp_path / "postings"))
    built = star.build_star(spark.read.parquet(str(tmp_path / "postings")).withColumn("job_id", F.monotonically_increasing_id()))
    for name in ("jobs", "job_skills", "skill_details"):
        plan = built[name]._jdf.queryExecution().executedPlan().toString()
        assert "BuildRight" in plan and "BuildLeft" not in plan, name
    assert built["jobs"].count() == 500 and built["job_skills"].count() == 1000
