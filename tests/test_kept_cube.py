"""The cube kept by day against the cube of the same postings."""

import datetime
import random

import pytest

from hirelens.operators.analyses import market_cube
from hirelens.plans import kept_cube
from hirelens.plans.kept_cube import CommitConflict, KeptCube

SCHEMA = "group string, location string, experience string, salary_normalized long"
DAYS = [datetime.date(2025, 1, 30), datetime.date(2025, 1, 31), *[datetime.date(2025, 2, n) for n in (1, 2, 3)]]


def rows(df):
    return sorted((r.level, r.group or "", r.city or "", r.experience or "", r.postings, r.avg_salary_vnd or -1.0) for r in df.collect())


def postings(spark, seed, n=40):
    rng = random.Random(seed)
    return spark.createDataFrame([(
        rng.choice(["Web", "Data", None]), rng.choice(["Hà Nội", "Huế, Hà Nội", "Huế, Huế", "", None]),
        rng.choice(["1 năm", "2 năm", None]), rng.choice([None, rng.randrange(10**9)])) for _ in range(n)], SCHEMA)


@pytest.fixture(scope="module")
def history(spark):
    return {day: postings(spark, i) for i, day in enumerate(DAYS)}


@pytest.fixture
def cube(spark, history, tmp_path):
    cube = KeptCube(spark, str(tmp_path / "cube"))
    for day, df in history.items():
        cube.put_day(day, df)
    return cube


def union(frames):
    first, *others = frames
    for df in others:
        first = first.union(df)
    return first


def test_equals_the_cube_of_all_postings(cube, history):
    assert rows(cube.cube()) == rows(market_cube(union(history.values())))
    part = [history[day] for day in DAYS[1:4]]
    assert rows(cube.cube(DAYS[1], DAYS[3])) == rows(market_cube(union(part)))
    assert cube.days() == DAYS


def test_a_folded_month_is_read_in_place_of_its_days(cube, history):
    whole = rows(cube.cube())
    assert cube.fold() == ["2025-01", "2025-02"] and cube.fold() == []
    assert len(cube.folders()) == 2 and rows(cube.cube()) == whole
    # A range that cuts February takes January's sums and two days.
    assert len(cube.folders(last=DAYS[3])) == 3
    assert rows(cube.cube(last=DAYS[3])) == rows(market_cube(union([history[d] for d in DAYS[:4]])))
    # Only the cells of these folders are read.
    read = cube.cube().inputFiles()
    assert {f.split("/cube/")[1].split("/")[0] for f in read} == set(cube.folders())


def test_a_day_put_again_or_dropped_makes_its_month_stale(spark, cube, history):
    cube.fold()
    again = postings(spark, 99)
    cube.put_day(DAYS[0], again)
    assert len(cube.folders()) == 3
    assert rows(cube.cube()) == rows(market_cube(union([again, *[history[d] for d in DAYS[1:]]])))
    assert cube.fold() == ["2025-01"]
    cube.put_day(DAYS[4], again.limit(0))
    cube.drop_day(DAYS[1])
    left = rows(market_cube(union([again, history[DAYS[2]], history[DAYS[3]]])))
    assert rows(cube.cube()) == left
    cube.drop_unused()
    assert rows(cube.cube()) == left and cube.drop_unused() == []


def test_an_empty_cube(spark, tmp_path):
    cube = KeptCube(spark, str(tmp_path / "cube"))
    nothing = rows(market_cube(postings(spark, 0, 0)))
    assert rows(cube.cube()) == nothing and cube.days() == [] and cube.fold() == []
    cube.put_day(DAYS[0], postings(spark, 0, 0))
    assert rows(cube.cube()) == nothing


def test_two_writers_keep_both_days(spark, history, tmp_path, monkeypatch):
    cube, write, inside = KeptCube(spark, str(tmp_path / "cube")), KeptCube._write, []

    def interrupted(self, cells):
        if not inside:
            inside.append(True)
            cube.put_day(DAYS[1], history[DAYS[1]])
        return write(self, cells)

    monkeypatch.setattr(KeptCube, "_write", interrupted)
    cube.put_day(DAYS[0], history[DAYS[0]])
    assert cube.days() == DAYS[:2]
    # A fold that a changed day overtakes is kept, but not read.
    inside.clear()
    again = postings(spark, 7)
    monkeypatch.setattr(KeptCube, "_write", lambda self, cells: write(self, cells))
    entry = cube._entry()[1]
    cube.put_day(DAYS[0], again)
    cube._commit(lambda e: e | {"months": {"2025-01": {"days": entry["days"], "folder": "stale"}}})
    assert rows(cube.cube()) == rows(market_cube(union([again, history[DAYS[1]]])))


def test_gives_up_after_some_tries(spark, history, tmp_path, monkeypatch):
    monkeypatch.setattr(kept_cube.Versions, "commit", lambda *_: (_ for _ in ()).throw(CommitConflict("taken")))
    with pytest.raises(CommitConflict):
        KeptCube(spark, str(tmp_path / "cube"), tries=2).put_day(DAYS[0], history[DAYS[0]])
