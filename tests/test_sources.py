import json

import pytest
from pyspark.sql import functions as F

from hirelens.plans.clean import clean_postings
from hirelens.schemas import FLAT_FIELDS, JOB_FIELDS
from hirelens.sources.versions import CommitConflict, Versions
from hirelens.sources import blocks, flat, keyvalue, tables


def job(**fields):
    return {name: fields.get(name, "x") for name in JOB_FIELDS}


@pytest.fixture
def crawl(tmp_path):
    files = {
        "a.json": json.dumps([
            {"group": "Python", "jobs": [job(title="t1"), job(title="t2", requirements=None, deadline=None)]},
            {"group": "Empty", "jobs": []},
            {"skill": "Go", "jobs": [job(title="t3")]},
        ], ensure_ascii=False, indent=2),
        "b.json": json.dumps([{"group": "Tiếng Anh", "jobs": [job(title="t4")]}], ensure_ascii=False),
        "empty.json": "",
        "nothing.json": "[]",
        "broken.json": '[{"group": "x", "jobs": [',
    }
    for name, content in files.items():
        (tmp_path / name).write_text(content, encoding="utf-8")
    return str(tmp_path)


def test_read_blocks(spark, crawl):
    rows = blocks.read_blocks(spark, crawl).orderBy("title").collect()
    assert [(r.group, r.source, r.pos, r.title) for r in rows] == [
        ("Python", "a.json", 0, "t1"), ("Python", "a.json", 1, "t2"), (None, "a.json", 0, "t3"),
        ("Tiếng Anh", "b.json", 0, "t4")]
    assert rows[1].requirements is None
    with_old_key = blocks.read_blocks(spark, crawl, drifted_key=True).filter("title = 't3'").first()
    assert with_old_key.group == "Go"


def test_broken_blocks(spark, crawl):
    (row,) = blocks.broken_blocks(spark, crawl).collect()
    assert row.file.endswith("broken.json") and row.record.startswith('[{"group"')


def test_read_ungrouped(spark, tmp_path):
    (tmp_path / "flat.json").write_text(json.dumps([job(title="t1"), job(title="t2")]), encoding="utf-8")
    rows = blocks.read_ungrouped(spark, str(tmp_path)).orderBy("title").collect()
    assert [(r.group, r.source, r.title) for r in rows] == [(None, "flat.json", "t1"), (None, "flat.json", "t2")]


def test_clean_survives_nulls(spark, crawl):
    cleaned = clean_postings(blocks.read_blocks(spark, crawl)).filter("title = 't2'").first()
    assert (cleaned.requirements, cleaned.deadline, cleaned.skills) == ("", None, [])


def block_frame(spark, rows):
    kind = f"crawl_date date, source string, `group` string, jobs array<struct<{','.join(f'{f}:string' for f in JOB_FIELDS)}>>"
    frame = spark.createDataFrame(
        [(d, s, g, [[t] + ["x"] * (len(JOB_FIELDS) - 1) for t in titles]) for d, s, g, titles in rows],
        "crawl_date string, " + kind.split(", ", 1)[1])
    return frame.withColumn("crawl_date", F.to_date("crawl_date"))


def test_day_layout(spark, tmp_path):
    root = str(tmp_path / "days")
    first = block_frame(spark, [("2025-10-07", "a", "g", ["t1", "t2"]), ("2025-10-07", "b", "g", ["t3"])])
    blocks.append_blocks(first, root)
    blocks.append_blocks(block_frame(spark, [("2025-10-08", "a", "g", ["t4"])]), root)
    day = blocks.read_layout(spark, root).filter("crawl_date = '2025-10-07'")
    assert day.inputFiles() and blocks.flatten(day).count() == 3
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crawl_date" in plan
    blocks.replace_days(block_frame(spark, [("2025-10-07", "a", "g", ["t9"])]), root)
    titles = {r.title for r in blocks.flatten(blocks.read_layout(spark, root)).collect()}
    assert titles == {"t9", "t3", "t4"}


def test_merge(spark):
    crawled = block_frame(spark, [
        ("2025-10-07", "a", "g", ["t1", "t2"]), ("2025-10-07", "a", "h", []), ("2025-10-07", "b", "g", ["t3"]),
        ("2025-10-08", "a", "g", ["t4"]), ("2025-10-08", "c", "g", ["t5"])])
    (row,) = blocks.merged_totals(crawled, ["a", "b"]).collect()
    assert (str(row.crawl_date), row.blocks_a, row.blocks_b, row.total_blocks, row.total_jobs) == ("2025-10-07", 2, 1, 3, 3)
    merged = blocks.flatten(blocks.complete_days(crawled, ["a", "b"]))
    assert {r.title for r in merged.collect()} == {"t1", "t2", "t3"}


def test_csv_roundtrip_keeps_odd_texts(spark, tmp_path):
    raw = spark.createDataFrame(
        [("Data, AI", 'say "hi"', "10 triệu", " padded ", "line\r\nend", None, "Python; \\ go")],
        "`group` string, title string, salary string, location string, description string, deadline string, requirements string")
    for name in JOB_FIELDS:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    exported = flat.flat_export(clean_postings(raw))
    path = str(tmp_path / "csv")
    flat.write_flat_csv(exported, path)
    back = flat.read_flat_csv(spark, path)
    assert back.columns == FLAT_FIELDS
    assert back.collect() == exported.collect()
    (row,) = flat.typed(back).collect()
    assert (row.group, row.title, row.salary_normalized, row.location, row.deadline, row.skills) == (
        "Data, AI", 'say "hi"', 10_000_000, "padded", "", "Python, go")
    assert row.description == "line  end"


def test_foreign_csv_with_line_ends(spark, tmp_path):
    path = tmp_path / "x.csv"
    line = ["g", '"a\nb"', *[""] * 12, '"p, q"']
    path.write_text(",".join(FLAT_FIELDS) + "\n" + ",".join(line) + "\n", encoding="utf-8")
    (row,) = flat.read_flat_csv(spark, str(path), multi_line=True).collect()
    assert (row.title, row.skills, row.link) == ("a\nb", "p, q", "")


def test_key_values(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = [("a", "1.50"), ("b", "x"), ("", "3"), ("c", None), ("d\te", "4")]
    keyvalue.write_key_values(spark.createDataFrame(rows, "k string, v string"), path)
    found = {(r.key, r.value, r.number) for r in keyvalue.read_key_values(spark, path).collect()}
    assert found == {("a", "1.50", 1.5), ("b", "x", None)}


def test_snapshot_and_restore(spark, tmp_path):
    tables.create_database(spark, "first_db", str(tmp_path / "first"))
    frames = {"one": spark.range(5), "two": spark.createDataFrame([(1, "a")], "id int, name string")}
    tables.save_tables(frames, "first_db", buckets={"one": (2, "id")})
    assert {"first_db", "default"} <= set(tables.user_databases(spark))
    snap = str(tmp_path / "snap")
    assert tables.snapshot(spark, "first_db", snap) == ["one", "two"]
    assert tables.restore(spark, snap, "second_db", str(tmp_path / "second")) == ["one", "two"]
    tables.save_tables({"three": spark.range(1)}, "second_db")
    assert tables.restore(spark, snap, "second_db") == ["one", "two"]
    assert set(tables.read_tables(spark, "second_db")) == {"one", "two"}
    assert spark.table("second_db.two").collect() == frames["two"].collect()
    assert spark.table("second_db.one").count() == 5
    assert tables._buckets(spark, "second_db.one") == (2, ["id"])
    # A later snapshot that was cut off before its list was written does not count.
    spark.range(3).write.parquet(f"{snap}/half/one")
    tables.save_tables({"one": spark.range(9)}, "first_db")
    assert tables.restore(spark, snap, "second_db") == ["one", "two"] and spark.table("second_db.one").count() == 5
    tables.snapshot(spark, "first_db", snap)
    tables.restore(spark, snap, "second_db")
    assert spark.table("second_db.one").count() == 9


def written(spark, snap):
    return {name: (told["written"], len(told["content"])) for name, told in Versions(spark, snap).last()[1]["tables"].items()}


def test_a_snapshot_writes_only_what_changed(spark, tmp_path):
    tables.create_database(spark, "grown_db", str(tmp_path / "db"))
    rows = spark.range(2000).selectExpr("id", "if(id % 3 = 0, null, id) AS a", "if(id % 5 = 0, null, id) AS b", "array(id, null) AS l")
    tables.save_tables({"one": rows, "two": rows.limit(0)}, "grown_db")
    snap = str(tmp_path / "snap")
    tables.snapshot(spark, "grown_db", snap, rows_per_part=100)
    assert written(spark, snap) == {"one": (20, 20), "two": (0, 0)}
    # The same rows in other files and another order.
    tables.save_tables({"one": rows.orderBy(F.desc("id")).repartition(3)}, "grown_db")
    tables.snapshot(spark, "grown_db", snap, rows_per_part=100)
    assert written(spark, snap)["one"] == (0, 20)
    # One more row, and one whose null moved to the other column.
    moved = rows.filter("id <> 3").union(spark.sql("SELECT 3L, 3L, NULL, array(3L, NULL)")).union(spark.sql("SELECT 9000L, 1L, 2L, array()"))
    tables.save_tables({"one": moved}, "grown_db")
    tables.snapshot(spark, "grown_db", snap, rows_per_part=100)
    assert 1 <= written(spark, snap)["one"][0] <= 3
    assert tables.restore(spark, snap, "grown_again", str(tmp_path / "again")) == ["one", "two"]
    back = spark.table("grown_again.one")
    assert back.exceptAll(moved).isEmpty() and moved.exceptAll(back).isEmpty() and spark.table("grown_again.two").columns == rows.columns
    # Another column: everything is new.
    tables.save_tables({"one": moved.withColumn("c", F.lit(1))}, "grown_db")
    tables.snapshot(spark, "grown_db", snap, rows_per_part=100)
    assert written(spark, snap)["one"][0] == written(spark, snap)["one"][1]


def test_versions_are_numbered_and_conflicts_are_told(spark, tmp_path):
    versions = Versions(spark, str(tmp_path))
    assert versions.last() == (0, None)
    assert versions.commit(0, {"a": 1}) == 1 and versions.commit(1, {"a": "é"}) == 2
    for after in (0, 1):
        with pytest.raises(CommitConflict):
            versions.commit(after, {"a": 3})
    assert versions.last() == (2, {"a": "é"})
    (tmp_path / "_versions" / "000000000003.json").write_text('{"a"')  # still being written
    assert versions.last() == (2, {"a": "é"})
    with pytest.raises(CommitConflict):
        versions.commit(2, {"a": 3})
