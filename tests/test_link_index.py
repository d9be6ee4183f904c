"""The stored index of links: what it finds, and how little it reads."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from hirelens.plans import daily
from hirelens.sources import blocks
from hirelens.sources.link_index import KEY, LinkIndex
from hirelens.streaming.ingest import ingest_stream
from hirelens.workspace import exists, remove
from test_ingest import DAYS, ROWS, SOURCES, crawl, result

DAY = datetime.date(2025, 1, 1)


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], f"{KEY} string")


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Twelve days of 300 links of their own."""
    index = LinkIndex(spark, str(tmp_path_factory.mktemp("index")), buckets=16, blocks=1 << 10)
    days = {DAY + datetime.timedelta(n): [f"/{n}/{i}" for i in range(300)] for n in range(12)}
    for day, keys in days.items():
        index.put(day, frame(spark, keys))
    return index, days


def test_known_keys_equal_a_plain_search(spark, history):
    index, days = history
    rng = random.Random(1)
    every = [(d, k) for d, keys in days.items() for k in keys]
    for own in (DAY, DAY + datetime.timedelta(99)):
        asked = [k for _, k in rng.sample(every, 40)] + [f"/new/{i}" for i in range(500)] + ["", "ünï"]
        expected = sorted(k for k in asked if any(d != own and k == x for d, x in every))
        assert sorted(r[KEY] for r in index.known(frame(spark, asked), own).collect()) == expected


def test_reads_grow_with_the_new_day_only(spark, history):
    index, days = history
    tomorrow = DAY + datetime.timedelta(50)
    old = [keys[7] for keys in list(days.values())[:5]]
    found = index.segments(frame(spark, old + [f"/new/{i}" for i in range(50)]), tomorrow)
    # 192 buckets are there; the five that hold a link are read, and next to none besides.
    assert {d for d, _ in found} >= set(list(days)[:5]) and 5 <= len(found) <= 7
    read = index.read(found)
    assert len({f.rsplit("/", 1)[0] for f in read.inputFiles()}) == len(found)
    assert read.count() < 7 * 60
    assert index.segments(frame(spark, [f"/other/{i}" for i in range(20)]), tomorrow) == []


def test_a_day_is_replaced_extended_and_left_out(spark, tmp_path):
    index = LinkIndex(spark, str(tmp_path / "i"), buckets=4, blocks=64)
    other = DAY + datetime.timedelta(1)
    known = lambda *keys: sorted(r[KEY] for r in index.known(frame(spark, keys), other).collect())
    assert known("a") == [] and index.last_day() is None and not index.has_day(DAY)
    index.put(DAY, frame(spark, ["a", "b", "b"]))
    assert known("a", "b", "c") == ["a", "b"] and index.last_day() == DAY
    for _ in range(2):
        index.add(DAY, frame(spark, ["c"]))
    assert known("a", "c", "d") == ["a", "c"]
    assert index.known(frame(spark, ["a"]), DAY).count() == 0
    index.put(DAY, frame(spark, ["d"]))
    assert known("a", "b", "c", "d") == ["d"]
    index.put(DAY, frame(spark, []))
    assert known("d") == [] and index.has_day(DAY)
    with pytest.raises(ValueError):
        LinkIndex(spark, "x", buckets=3, blocks=64)
    again = LinkIndex(spark, index.path, buckets=32, blocks=128)
    assert (again.buckets, again.blocks) == (4, 64)  # as it was made


def test_crowded_blocks_lose_nothing(spark, tmp_path):
    index = LinkIndex(spark, str(tmp_path / "i"), buckets=1, blocks=1)
    index.put(DAY, frame(spark, [f"k{i}" for i in range(3000)]))
    asked = [f"k{i}" for i in range(2500, 3500)]
    assert index.known(frame(spark, asked), DAY + datetime.timedelta(1)).count() == 500


def test_index_of_an_older_target_is_built(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    blocks.append_blocks(crawl(spark, ROWS), raw)
    daily.ingest_day(spark, raw, target, DAYS[0], SOURCES)
    remove(spark, f"{target}/_links")
    daily.ingest_day(spark, raw, target, DAYS[2], SOURCES)
    assert {r[3] for r in result(spark, target) if r[0] == DAYS[2]} == {"/4", "/9"}
    assert exists(spark, f"{target}/_links/filters/crawl_date={DAYS[0]}")


def test_null_groups_and_links(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    same = [(d, s, g, ["/1", None]) for d in DAYS[:2] for s in SOURCES for g in ("g", None)]
    blocks.append_blocks(crawl(spark, [r for r in same if r[2]] + [(d, s, None, f) for d, s, g, f in same if g is None]), raw)
    for day in DAYS[:2]:
        daily.ingest_day(spark, raw, target, day, SOURCES)
    rows = daily.read_target(spark, target).select("crawl_date", "group", "link").collect()
    assert {r.crawl_date for r in rows} == {DAYS[0]}
    assert len(rows) == len(set(rows))


LATE = [(DAYS[0], "a", "g", ["/1", "/late", "/late"]), (DAYS[0], "a", "h", ["/4"]), (DAYS[0], "b", "g", ["/4", "/9"])]


@pytest.mark.parametrize("late_after, expected", [(0, 9), (2, 9), (3, 8)])
def test_late_files_add_what_they_bring(spark, tmp_path, late_after, expected):
    raw, target, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))
    blocks.append_blocks(crawl(spark, ROWS), raw)
    ingest_stream(spark, raw, target, progress, SOURCES)
    before = result(spark, target)
    files = set(daily.read_target(spark, target).inputFiles())
    blocks.append_blocks(crawl(spark, LATE), raw)
    for _ in range(2):
        ingest_stream(spark, raw, target, progress, SOURCES, late_after=late_after)
    found = result(spark, target)
    # /4 and /9 of group g belong to the last day already; /late and /4 of group h are new.
    assert set(found) == set(before) | {(DAYS[0], "a", "g", "/late"), (DAYS[0], "a", "h", "/4")}
    assert len(found) == len(before) + 2
    kept = files & set(daily.read_target(spark, target).inputFiles())
    assert (kept == files) == (late_after < 3)  # a late file leaves what is there untouched
    again = len(found)
    daily.append_late(spark, [f"{raw}/crawl_date={DAYS[0]}"], raw, target, DAYS[0], SOURCES)
    assert len(result(spark, target)) == again


def test_plan_of_known_has_no_scan_of_the_history(spark, history):
    index, _ = history
    plan = index.known(frame(spark, ["/new/1"]), DAY + datetime.timedelta(50))._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()


def test_key_column_may_be_there_already(spark, tmp_path):
    index = LinkIndex(spark, str(tmp_path / "i"))
    index.put(DAY, frame(spark, ["a"]).withColumn("block", F.lit("x")).withColumn("bucket", F.lit("y")))
    assert index.known(frame(spark, ["a"]), DAY + datetime.timedelta(1)).count() == 1
