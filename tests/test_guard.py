"""Constraints checked on what a load adds, against the checks of whole tables."""

import random

import pytest
from pyspark.sql import functions as F

from hirelens.operators import quality
from hirelens.plans import star
from hirelens.plans.guard import ConstraintError
from hirelens.schemas import CLEANED
from test_model import posting

PARTS = 4


def frame(spark, rows):
    return spark.createDataFrame(rows, CLEANED)


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    """A model of several parts."""
    path = str(tmp_path_factory.mktemp("guard") / "star")
    rng = random.Random(3)
    rows = [posting(f"G{rng.randrange(6)}", f"t{i}", [f"s{rng.randrange(12)}", "SQL"]) for i in range(400)]
    star.load_star(frame(spark, rows[:250]), path)
    for at in range(250, 400, 50):
        star.extend_star(frame(spark, rows[at:at + 50]), path, check=True)
    return path, star.current_parts(spark, path)


def counts(df):
    return {(r.rule, r.subject): r.offending_rows for r in df.collect()}


def joined(spark, path, added):
    old = star.read_star(spark, path)
    return {name: old[name].unionByName(added[name]) for name in star.TABLES}


def nothing(spark, path):
    return {name: df.limit(0) for name, df in star.read_star(spark, path).items()}


def test_additions_equal_the_checks_of_all_tables(spark, model):
    path, parts = model
    old = star.read_star(spark, path)
    assert len(parts) == PARTS and set(counts(quality.violations(old)).values()) == {0}
    jobs = old["jobs"]
    new_jobs = jobs.limit(30).withColumn("id", F.concat(F.lit("new"), "id"))
    added = nothing(spark, path) | {
        # Ids the model has, ids twice in the additions, ids both, and rows without an id.
        "jobs": new_jobs.union(new_jobs.limit(4)).union(jobs.orderBy("id").limit(9)).union(jobs.orderBy("id").limit(2))
        .union(new_jobs.limit(3).withColumn("id", F.lit(None).cast("string")))
        .union(new_jobs.limit(2).withColumns({"id": F.concat(F.lit("long"), "id"), "title": F.repeat(F.lit("x"), 300)}))
        .union(new_jobs.limit(1).withColumns({"id": F.lit("lost"), "group_id": F.lit(999).cast("bigint")})),
        # Known and new jobs, unknown jobs and skills.
        "job_skills": spark.createDataFrame([("new-none", 1), (None, 2), ("none", 77), ("none", 77)], "job_id string, skill_id long")
        .union(new_jobs.select(F.col("id").alias("job_id"), F.lit(1).cast("bigint"))).union(old["job_skills"].orderBy("job_id", "skill_id").limit(5)),
        "skills": spark.createDataFrame([(1, "again"), (500, "SQL"), (501, "fresh"), (502, None)], "id long, name string"),
        "skill_details": spark.createDataFrame([(501, 1), (503, 1)], "skill_id long, group_id long"),
    }
    expected = counts(quality.violations(joined(spark, path, added)))
    assert counts(star.guard(spark, path).violations(added, parts)) == expected
    assert expected["unique", "jobs(id)"] >= 14 and expected["foreign key", "jobs.group_id"] == 1
    assert expected["unique", "skills(name)"] == 1 and expected["foreign key", "skill_details.skill_id"] == 1


def test_nothing_added_breaks_nothing(spark, model):
    path, parts = model
    found = counts(star.guard(spark, path).violations(nothing(spark, path), parts))
    assert found == counts(quality.violations(nothing(spark, path))) and set(found.values()) == {0}


def test_an_indexed_part_is_not_read_again(spark, model, monkeypatch):
    path, parts = model
    guard = star.guard(spark, path)
    guard.violations(nothing(spark, path), parts)
    read = []
    guard.read = lambda part: read.append(part) or star._parts(spark, path, [part])
    few = star.read_star(spark, path)["jobs"].orderBy("id").limit(2)
    found = guard.violations(nothing(spark, path) | {"jobs": few}, parts)
    assert counts(found)["unique", "jobs(id)"] == 2 and read == []
    # Of the 16 buckets of each part only those that may hold the two ids are read.
    index = guard._index("jobs", ["id"], parts)
    assert 2 <= len(index.segments(few.select(F.to_json(F.struct("id")).alias("_key")), parts)) <= 4


def test_a_load_that_breaks_a_rule_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "star")
    star.load_star(frame(spark, [posting("Web", "a", ["x"])]), path)
    before = star.current_parts(spark, path)
    for bad, rule in [([posting("Web", "b" * 256, ["x"])], "length jobs: 1"),
                      ([posting("Web", None, ["x"])], "required jobs: 1"),
                      ([posting("G" * 101, "b", ["x"])], "length skill_groups: 1")]:
        with pytest.raises(ConstraintError, match=rule):
            star.extend_star(frame(spark, bad), path, check=True)
    twice = frame(spark, [posting("Web", "c", ["x"])] * 2).withColumn("job_id", F.lit("7"))
    with pytest.raises(ConstraintError, match=r"unique jobs\(id\): 1"):
        star.extend_star(twice, path, check=True)
    assert star.current_parts(spark, path) == before
    assert {p.name for p in (tmp_path / "star").iterdir()} == {*before, "_versions", "_keys"}
    star.extend_star(frame(spark, [posting("Web", "d", ["y"])]), path, check=True)
    assert len(star.current_parts(spark, path)) == 2


def test_parts_that_were_merged_are_forgotten(spark, tmp_path):
    path = str(tmp_path / "star")
    star.load_star(frame(spark, [posting("Web", "a", ["x"])]), path)
    for title in "bcd":
        star.extend_star(frame(spark, [posting("Web", title, [title])]), path, check=True)
    star.compact_star(spark, path, most=1)
    star.drop_unused(spark, path)
    parts, guard = star.current_parts(spark, path), star.guard(spark, path)
    again = nothing(spark, path) | {"skills": star.read_star(spark, path)["skills"]}
    assert counts(guard.violations(again, parts))["unique", "skills(id)"] == 4
    assert guard._index("jobs", ["id"], parts).entries() == sorted(parts)
