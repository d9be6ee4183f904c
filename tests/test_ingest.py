import datetime
import json

import pytest
from pyspark.sql import functions as F

from hirelens.operators.links import new_links
from hirelens.plans import daily
from hirelens.plans.daily import ingest_day, read_target
from hirelens.schemas import JOB_FIELDS
from hirelens.sources import blocks
from hirelens.streaming.ingest import ingest_stream

SOURCES = ["a", "b"]
DAYS = [datetime.date(2025, 10, d) for d in (7, 8, 9)]


def crawl(spark, rows):
    """Rows are (day, source, group, [links])."""
    flat = [(d, s, g, pos, link) for d, s, g, found in rows for pos, link in enumerate(found)]
    df = spark.createDataFrame(flat, "crawl_date date, source string, `group` string, pos int, link string")
    fields = [F.col("link") if f == "link" else F.lit("10 triệu" if f == "salary" else "Python") for f in JOB_FIELDS]
    job = F.struct(*[c.alias(f) for c, f in zip(fields, JOB_FIELDS)])
    ordered = F.array_sort(F.collect_list(F.struct("pos", job.alias("job"))))
    return (df.groupBy("crawl_date", "source", "group").agg(ordered.alias("j"))
            .select("crawl_date", "source", "group", F.transform("j", lambda x: x["job"]).alias("jobs")))


ROWS = [
    (DAYS[0], "a", "g", ["/1", "/2", "/1"]), (DAYS[0], "b", "g", ["/2", "/3"]), (DAYS[0], "b", "h", ["/1"]),
    (DAYS[1], "a", "g", ["/9"]),
    (DAYS[2], "a", "g", ["/1", "/4"]), (DAYS[2], "b", "g", ["/3", "/4", "/9"]),
]
DAILY = {(DAYS[0], "a", "g", "/1"), (DAYS[0], "a", "g", "/2"), (DAYS[0], "b", "g", "/3"), (DAYS[0], "b", "h", "/1"),
         (DAYS[2], "a", "g", "/4"), (DAYS[2], "b", "g", "/9")}


def result(spark, target):
    rows = read_target(spark, target).collect()
    assert all(r.salary_normalized == 10_000_000 and r.skills == ["Python"] for r in rows)
    return sorted((r.crawl_date, r.source, r.group, r.link) for r in rows)


def test_daily(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    blocks.append_blocks(crawl(spark, ROWS), raw)
    for day in DAYS:
        ingest_day(spark, raw, target, day, SOURCES)
    # The second day lacks a source, so its link counts as new on the third.
    assert result(spark, target) == sorted(DAILY)
    ingest_day(spark, raw, target, DAYS[2], SOURCES)
    ingest_day(spark, raw, target, DAYS[0], SOURCES)
    assert result(spark, target) == sorted(DAILY)


def keys(rows):
    return sorted((r[-2], r[-1]) for r in rows)


def test_stream_equals_batch(spark, tmp_path):
    """All columns, on links that repeat over days and sources."""
    raw, target, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))
    batch_raw, batch = str(tmp_path / "raw2"), str(tmp_path / "out2")
    rows = [(d, s, "g", [f"/{i % 40}" for i in range(60)] + [f"/{d}{s}"]) for d in DAYS for s in SOURCES]
    for some in (rows[:4], rows[4:]):
        blocks.append_blocks(crawl(spark, some), raw)
        blocks.append_blocks(crawl(spark, some), batch_raw)
        ingest_stream(spark, raw, target, progress, SOURCES, max_files=1)
    for day in DAYS:
        ingest_day(spark, batch_raw, batch, day, SOURCES)
    streamed = sorted(map(str, read_target(spark, target).collect()))
    assert streamed == sorted(map(str, read_target(spark, batch).collect())) and len(streamed) == 40 + 6
    ingest_stream(spark, raw, target, progress, SOURCES)
    assert sorted(map(str, read_target(spark, target).collect())) == streamed


def test_late_days_are_kept(spark, tmp_path):
    raw, target, progress = (str(tmp_path / n) for n in ("raw", "out", "progress"))
    for rows in (ROWS[4:], [(datetime.date(2025, 9, 1), s, "g", [f"/late{s}", "/4"]) for s in SOURCES]):
        blocks.append_blocks(crawl(spark, rows), raw)
        ingest_stream(spark, raw, target, progress, SOURCES)
    found = result(spark, target)
    assert {r[3] for r in found if r[0].month == 9} == {"/latea", "/lateb"}  # the copy ingested first stays
    assert len(found) == len({r[2:] for r in found}) == 6


def test_backfill_and_emptied_day(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "out")
    same = lambda day: [(day, s, "g", ["/1", "/2", f"/{day}{s}"]) for s in SOURCES]
    blocks.append_blocks(crawl(spark, same(DAYS[1])), raw)
    ingest_day(spark, raw, target, DAYS[1], SOURCES)
    blocks.append_blocks(crawl(spark, same(DAYS[0])), raw)
    ingest_day(spark, raw, target, DAYS[0], SOURCES)
    found = result(spark, target)
    assert len(found) == len({r[2:] for r in found}) == 6
    ingest_day(spark, raw, target, DAYS[1], SOURCES)
    assert result(spark, target) == found
    empty = crawl(spark, same(DAYS[1])).withColumn("jobs", F.slice("jobs", 1, 0))
    blocks.replace_days(empty, raw)
    ingest_day(spark, raw, target, DAYS[1], SOURCES)
    assert {r[0] for r in result(spark, target)} == {DAYS[0]}


def test_indented_files_and_broken_ones(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "out")
    for s in SOURCES:
        folder = raw / "crawl_date=2025-10-07" / f"source={s}"
        folder.mkdir(parents=True)
        job = {f: "10 triệu" if f == "salary" else "Python" for f in JOB_FIELDS}
        (folder / "x.json").write_text(json.dumps([{"group": "g", "jobs": [job | {"link": f"/{s}"}]}], indent=4))
    ingest_day(spark, str(raw), target, DAYS[0], SOURCES, multi_line=True)
    assert [r[3] for r in result(spark, target)] == ["/a", "/b"]
    (folder / "y.json").write_text('[{"group": ')
    layout = blocks.read_layout(spark, str(raw), multi_line=True)
    assert [(r.source, r.file.rsplit("/", 1)[1]) for r in blocks.broken_layout(layout).collect()] == [("b", "y.json")]
    with pytest.raises(ValueError, match="y.json"):
        ingest_day(spark, str(raw), target, DAYS[0], SOURCES, multi_line=True)


def test_files_are_parsed_once(spark, tmp_path, monkeypatch):
    """Every file of a day was parsed a first time only to see whether it can be."""
    raw, target, calls = str(tmp_path / "raw"), str(tmp_path / "out"), []
    readable = daily._readable
    monkeypatch.setattr(daily, "_readable", lambda *args: calls.append(args) or readable(*args))
    blocks.append_blocks(crawl(spark, ROWS), raw)
    ingest_day(spark, raw, target, DAYS[0], SOURCES)
    assert not calls and read_target(spark, target).count() == 4
    (tmp_path / "raw" / f"crawl_date={DAYS[2]}" / "source=a" / "cut.json").write_text('{"group": "g", "jobs": [')
    with pytest.raises(ValueError, match="cut.json"):
        ingest_day(spark, raw, target, DAYS[2], SOURCES)
    assert len(calls) == 1


def test_two_shuffles(spark):
    rows = spark.createDataFrame([("g", "/1", 1)], "`group` string, link string, n int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = new_links(rows, rows, ["n"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
