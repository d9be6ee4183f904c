import datetime

import pytest
from pyspark.sql import functions as F

from hirelens import workspace
from hirelens.operators import quality, search
from hirelens.plans import star
from hirelens.schemas import CLEANED


def posting(group, title, skills, **fields):
    row = dict.fromkeys(CLEANED.names)
    row |= {"group": group, "title": title, "link": f"/{title}", "skills": skills} | fields
    return tuple(row[name] for name in CLEANED.names)


@pytest.fixture(scope="module")
def postings(spark):
    day = datetime.date(2025, 10, 7)
    return spark.createDataFrame([
        posting(" Web ", "a", ["Python", "python", " SQL "], location="Hà Nội", salary_normalized=12_000_000,
                deadline=day, description="Flask", experience="1 năm"),
        posting("Web", "b", ["Python"], location="Huế", salary_normalized=10_000_000, experience="0 năm"),
        posting("Data", "c", [], location="Hà Nội, Huế", description="100% đẹp", deadline=day),
        posting("Data", "c", [], location="Hà Nội, Huế", description="100% đẹp", deadline=day),
        posting(None, "d", ["C#"], location=None),
    ], CLEANED)


@pytest.fixture(scope="module")
def tables(spark, postings, tmp_path_factory):
    return star.load_star(postings, str(tmp_path_factory.mktemp("star")))


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_dimensions(tables):
    assert values(tables["skill_groups"], "id", "name") == [(1, ""), (2, "Data"), (3, "Web")]
    assert values(tables["skills"], "id", "name") == [(1, "C#"), (2, "Python"), (3, "SQL"), (4, "python")]


def test_tables_rejoin_to_the_postings(tables, postings):
    back = star.rejoin(tables)
    assert back.count() == 4  # two postings are equal in every column
    rows = {(r.title, r.group, tuple(r.skills), r.description) for r in back.collect()}
    assert rows == {("a", "Web", ("Python", "SQL", "python"), "Flask"), ("b", "Web", ("Python",), None),
                    ("c", "Data", (), "100% đẹp"), ("d", "", ("C#",), None)}


def test_model_keeps_its_constraints(tables):
    assert quality.violations(tables).agg(F.sum("offending_rows")).first()[0] == 0


def test_loading_twice_gives_the_same(spark, postings, tables, tmp_path):
    path = str(tmp_path / "star")
    first = star.load_star(postings, path)
    second = star.load_star(postings, path)
    for name in star.TABLES:
        columns = tables[name].columns
        assert values(first[name], *map(lambda c: F.col(c).cast("string"), columns)) == values(
            second[name], *map(lambda c: F.col(c).cast("string"), columns))
    assert star.read_star(spark, path)["jobs"].inputFiles() == second["jobs"].inputFiles()


def test_case_blind_dimension(spark, postings):
    found = star.build_star(postings, case_blind=True)
    assert values(found["skills"], "id", "name") == [(1, "C#"), (2, "Python"), (3, "SQL")]
    assert found["job_skills"].count() == 4


def test_dense_ids_over_many_partitions(spark):
    names = spark.range(1000).select(F.format_string("n%05d", F.pmod(F.col("id") * 7919, F.lit(1000))).alias("name"))
    rows = star.dense_ids(names.repartition(7), after=10).orderBy("id").collect()
    assert [(r.id, r.name) for r in rows] == [(i + 11, f"n{i:05d}") for i in range(1000)]


def test_upsert(spark):
    existing = spark.createDataFrame([(4, "b"), (9, "d")], "id int, name string")
    names = spark.createDataFrame([("a",), (" b",), ("c",), ("c",), ("D",)], "name string")
    assert values(star.upsert_dimension(existing, names), "id", "name") == [
        (4, "b"), (9, "d"), (10, "D"), (11, "a"), (12, "c")]
    assert values(star.upsert_dimension(existing, names, case_blind=True), "id", "name") == [
        (4, "b"), (9, "d"), (10, "a"), (11, "c")]
    assert values(star.upsert_dimension(existing.limit(0), names.limit(1)), "id", "name") == [(1, "a")]


def titles(df):
    return [r.title for r in df.collect()]


def test_search(tables):
    assert sorted(titles(search.search(tables))) == ["a", "b", "c", "d"]
    # No deadline comes first, then by deadline.
    assert set(titles(search.search(tables))[:2]) == {"b", "d"}
    assert titles(search.search(tables, skill="Python", group="Web", location="Huế")) == ["b"]
    assert titles(search.search(tables, skill="pyth")) == []
    assert titles(search.search(tables, salary="10 - 20 triệu", experience="1 năm")) == ["a"]
    assert titles(search.search(tables, keyword="FLASK")) == ["a"]
    assert titles(search.search(tables, keyword="100% ĐẸP")) == ["c"]
    assert titles(search.search(tables, keyword="dep", ignore_accents=True)) == ["c"]
    (row,) = search.as_shown(search.search(tables, location="Hà Nội")).collect()
    assert (row.skills, row.description, row.benefits, row.group_name) == (
        "Python, SQL, python", "Flask", "Không có", "Web")


def test_facets_cover_the_search(tables):
    assert titles_of(search.facet_groups(tables)) == ["", "Data", "Web"]
    assert titles_of(search.facet_skills(tables)) == ["Python", "SQL", "python"]
    assert titles_of(search.facet_locations(tables)) == ["Huế", "Hà Nội"]
    found = search.search(tables).select("group_name").distinct()
    assert {r[0] for r in found.collect()} <= set(titles_of(search.facet_groups(tables)))


def titles_of(df):
    return [r[0] for r in df.collect()]


def test_delete_rows(tables):
    gone = tables["jobs"].filter("title = 'a'").select("id")
    left = quality.delete_rows(tables, "jobs", gone)
    assert {n: left[n].count() for n in star.TABLES} == {
        "skill_groups": 3, "skills": 4, "skill_details": 4, "jobs": 3, "job_details": 3, "job_skills": 2}
    left = quality.delete_rows(left, "skill_groups", left["skill_groups"].select("id"))
    assert left["skill_groups"].count() == 3 and left["skill_details"].count() == 4
    left = quality.delete_rows(left, "skills", left["skills"].filter("name = 'C#'").select("id"))
    assert left["skill_details"].count() == 3 and left["job_skills"].count() == 1


def test_checks_find_offenders(spark, tables):
    broken = tables | {
        "skills": tables["skills"].filter("id > 1"),
        "jobs": tables["jobs"].unionByName(tables["jobs"].limit(1))
        .withColumn("title", F.when(F.col("title") == "d", None).otherwise(F.repeat("title", 300))),
    }
    found = {(r.rule, r.subject): r.offending_rows for r in quality.violations(broken).collect() if r.offending_rows}
    assert found[("foreign key", "skill_details.skill_id")] == 1
    assert found[("foreign key", "job_skills.skill_id")] == 1
    assert found[("unique", "jobs(id)")] == 1
    assert found[("required", "jobs")] >= 1 and found[("length", "jobs")] >= 3


def test_two_loads_at_once_keep_both(spark, postings, tmp_path, monkeypatch):
    path = str(tmp_path / "star")
    one = lambda title, skill: spark.createDataFrame([posting("Web", title, [skill])], CLEANED)
    star.load_star(one("t1", "Python"), path)
    write, inside = star._write, []

    def interrupted(tables, where):
        """While the first load writes, a second one runs from start to end."""
        if not inside:
            inside.append(True)
            star.extend_star(one("t2", "Go"), path)
        return write(tables, where)

    monkeypatch.setattr(star, "_write", interrupted)
    tables = star.extend_star(one("t3", "Rust").union(one("t1", "Python")), path)
    assert values(tables["jobs"], "title") == [("t1",), ("t2",), ("t3",)]
    assert values(tables["skills"], "id", "name") == [(1, "Python"), (2, "Go"), (3, "Rust")]
    assert quality.violations(tables).agg(F.sum("offending_rows")).first()[0] == 0
    # What the first load had written before the conflict is gone.
    assert {p.name for p in (tmp_path / "star").iterdir()} == {*star.current_parts(spark, path), "_versions"}


def test_a_load_gives_up_after_some_tries(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "star")
    rows = spark.createDataFrame([posting("Web", "t1", ["a"])], CLEANED)
    star.load_star(rows, path)
    monkeypatch.setattr(star.Versions, "commit", lambda *_: (_ for _ in ()).throw(star.CommitConflict("taken")))
    with pytest.raises(star.CommitConflict):
        star.extend_star(rows, path, tries=2)


def test_small_parts_are_merged(spark, tmp_path):
    path = str(tmp_path / "star")
    base = spark.createDataFrame([posting("Web", f"b{i}", ["Python"], description="text " * i) for i in range(3000)], CLEANED)
    star.load_star(base, path)
    (large,) = star.current_parts(spark, path)
    for i in range(4):
        star.extend_star(spark.createDataFrame([posting("Web", f"t{i}", [f"s{i}"])], CLEANED), path)
    before = {name: sorted(map(str, df.collect())) for name, df in star.read_star(spark, path).items()}
    assert len(star.compact_star(spark, path, most=5)) == 5  # few enough
    parts = star.compact_star(spark, path, most=3)
    assert len(parts) == 2 and parts[0] == large
    after = {name: sorted(map(str, df.collect())) for name, df in star.read_star(spark, path).items()}
    assert after == before
    assert len(star.drop_unused(spark, path)) == 4
    assert {name: df.count() for name, df in star.read_star(spark, path).items()} == {name: len(rows) for name, rows in before.items()}


def test_scratch_of_a_load_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path / "shared"))
    rows = spark.createDataFrame([posting("Web", "t1", ["a"])], CLEANED)
    star.load_star(rows, str(tmp_path / "star"))
    star.extend_star(spark.createDataFrame([posting("Web", "t2", ["b"])], CLEANED), str(tmp_path / "star"))
    assert list((tmp_path / "shared").iterdir()) == []
