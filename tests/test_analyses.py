import pytest
from pyspark.sql import functions as F

from hirelens.operators import analyses, links, profile

SCHEMA = ("`group` string, title string, salary_normalized bigint, location string, experience string, skills string")


@pytest.fixture(scope="module")
def postings(spark):
    return spark.createDataFrame([
        ("Web", "a", 9_999_999, "Hà Nội", "0 năm", "Python, Go"),
        ("Web", "b", 10_000_000, "HỒ CHÍ MINH", "0.5 năm", "MicroPython,, x"),
        ("Data, AI", " c ", 30_000_000, "Hà Nội & Huế", "00 năm", " "),
        ("Data, AI", " ", 90_000_000, "Huế", "Không yêu cầu", "python"),
        (" ", "e", None, " Huế ", "10 năm", None),
        ("Web", "f\tg", 20_000_000, "", "0", "python"),
        ("Web", "h", 30_000_000, "Huế, Đà Nẵng và 3 nơi khác", "không yêu cầu kinh nghiệm", "go"),
    ], SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_filters(postings):
    assert rows(analyses.high_salary(postings)) == [("b", 10_000_000), ("c", 30_000_000), ("h", 30_000_000)]
    assert rows(analyses.in_cities(postings)) == [("a", "hà nội"), ("b", "hồ chí minh"), ("c", "hà nội & huế")]
    assert rows(analyses.no_experience(postings)) == [("a", "0 năm"), ("b", "0.5 năm"), ("h", "không yêu cầu kinh nghiệm")]
    assert rows(analyses.with_skill(postings)) == [("a", "python, go"), ("b", "micropython, , x")]


def test_aggregates(postings):
    assert rows(analyses.avg_salary_by_city(postings)) == [
        ("Huế", 90_000_000.0, 1), ("Hà Nội", 9_999_999.0, 1), ("HỒ CHÍ MINH", 10_000_000.0, 1)]
    assert rows(analyses.postings_by_group(postings)) == [("Data, AI", 2), ("Web", 4)]
    assert rows(analyses.postings_by_city(postings)) == [("Huế", 4), ("Hà Nội", 2), ("HỒ CHÍ MINH", 1), ("Đà Nẵng", 1)]


def test_top_k_and_ties(postings):
    assert [tuple(r) for r in analyses.top_paid_jobs(postings, 2).collect()] == [("h", 30_000_000), ("c", 30_000_000)]
    assert [tuple(r) for r in analyses.top_cities(postings, 3).collect()] == [("Huế", 4), ("Hà Nội", 2), ("HỒ CHÍ MINH", 1)]


def test_catalogue(postings):
    assert len(analyses.ANALYSES) == 8
    for name, analysis in analyses.ANALYSES.items():
        assert set(analysis.labels) <= set(analyses.run(name, postings).columns)


def test_cube(postings):
    cube = {(r.group, r.city, r.experience, r.level): (r.postings, r.avg_salary_vnd)
            for r in analyses.market_cube(postings).collect()}
    # A posting in two cities counts once where cities are summed over.
    assert cube[(None, None, None, 7)][0] == postings.count()
    for group, n in rows(analyses.postings_by_group(postings)):
        assert cube[(group, None, None, 3)][0] == n
    assert cube[(None, "Huế", None, 5)] == (4, pytest.approx(50_000_000))


def test_profile(spark):
    raw = spark.createDataFrame([("x", "a", ""), ("y", "", "1"), ("x", None, None)], "source string, location string, salary string")
    columns = "source, location, salary"
    assert set(map(tuple, profile.overview(raw).collect())) == {("x", 0, 2, columns), ("y", 0, 1, columns), (None, 1, 3, columns)}
    assert rows(profile.location_counts(raw)) == [("Không rõ", 2), ("a", 1)]
    assert rows(profile.salary_counts(raw)) == [("", 1), ("1", 1)]
    assert [tuple(r) for r in profile.top_values(profile.salary_counts(raw), 1).collect()] == [("", 1)]


def test_links(spark):
    df = spark.createDataFrame(
        [(1, "g", "/a"), (2, "g", "/a"), (3, "h", "/a"), (4, None, "/b"), (5, None, "/b"), (6, "g", "/brand/x")],
        "n int, `group` string, link string")
    assert [r.n for r in links.first_per_key(df, ["n"]).orderBy("n").collect()] == [1, 3, 4, 6]
    seen = df.filter("n = 3 or n = 4")
    assert [r.n for r in links.new_links(df, seen, ["n"]).orderBy("n").collect()] == [1, 6]
    assert [r.n for r in links.without_links(df).orderBy("n").collect()] == [1, 2, 3, 4, 5]
    assert links.only_group(df, "G").count() == 3


def test_blocked_pages(spark):
    df = spark.createDataFrame([(1, "<title>Just a Moment...</title>"), (2, "<title>Job</title>"), (3, "")], "n int, html string")
    assert [r.n for r in links.not_blocked(df).orderBy("n").collect()] == [2, 3]


@pytest.mark.parametrize("n", [3, 2000])
def test_cap_with_one_group_of_a_third(spark, n):
    df = spark.range(30_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("group"))
    kept = links.cap_per_group(df, ["id"], n=n)
    expected = {}
    for i in range(30_000):
        group = "hot" if i % 3 == 0 else f"g{i % 50}"
        if len(expected.setdefault(group, [])) < n:
            expected[group].append(i)
    assert sorted(r.id for r in kept.collect()) == sorted(sum(expected.values(), []))
