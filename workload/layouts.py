"""Posting pages in both shipped layouts, written around texts of the documents, and what they say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from workload.postings import table

# Words of one quarter of a document; only this differs between the engines.
QUARTER = "substr(d.text, {before} * CAST(ceil(length(d.text) / 4.0) AS INT) + 1, CAST(ceil(length(d.text) / 4.0) AS INT))"
SPARK_PART = f"coalesce(nullif(trim(regexp_replace({QUARTER}, '[^A-Za-z]+', ' ')), ''), 'none')"
DUCKDB_PART = f"coalesce(nullif(trim(regexp_replace({QUARTER}, '[^A-Za-z]+', ' ', 'g')), ''), 'none')"

# Nested blocks, line ends, a headline of the site before that of the posting, and labels that only look alike.
FIRST = """concat('<title>T | example.com</title><h1><a>Logo</a></h1><h1 class="b job-detail__info--title"><a>', @1@, ' <i>', @2@, '</i> (', @3@, ')</a></h1>',
  '<div class="job-detail__info--section"><div class="job-detail__info--section-content-title"><b>Mức</b> lương</div>',
  '<div><div class="job-detail__info--section-content-value"> ', @2@, ' &amp; ', @3@, ' </div></div></div>',
  '<div class="job-detail__info--section"><div class="job-detail__info--section-content-title">ĐỊA ĐIỂM</div>',
  '<div class="job-detail__info--section-content-value"><div>', @4@, '</div><div><div>', @1@, '</div></div></div></div>',
  '<div class="job-detail__info--section"><div class="job-detail__info--section-content-title">Kinh nghiệm</div></div>',
  '<div class="job-description__item"><h3>Mô tả công việc</h3><div class="job-description__item--content"><p>', @1@, '</p><p>', @2@,
  '</p><ul><li>', @3@, '</li><li>', @4@, '</li></ul><div>x<div>y</div></div>end</div></div>',
  '<div class="job-description__item"><h3>Yêu cầu ứng viên</h3> <div class="job-description__item--content">', @4@, '<br>', @3@, '</div></div>',
  '<div class="job-detail__information-detail--actions-label">Hết hạn trong ', CAST(d.doc_id % 30 AS STRING), ' ngày</div>')"""

FIRST_SAYS = """SELECT doc_id AS page_id, p.url AS link, concat(@1@, ' ', @2@) AS title, concat(@2@, ' & ', @3@) AS salary,
  concat(@4@, chr(10), @1@) AS location, '' AS experience,
  concat(@1@, chr(10), @2@, chr(10), @3@, chr(10), @4@, chr(10), 'x', chr(10), 'y', chr(10), 'end') AS description,
  concat(@4@, chr(10), @3@) AS requirements, '' AS benefits, '' AS work_location_detail, '' AS working_time,
  concat('Hạn nộp hồ sơ: ', strftime(DATE '2025-10-07' + CAST(d.doc_id % 30 AS INTEGER), '%d/%m/%Y')) AS deadline"""

SECOND = """concat('<h1>Logo</h1><h1 class="sc-ab270149-0 hAejeW">', @1@, ' <span>', @2@, '</span> Eng</h1>',
  '<span class="sc-ab270149-0 ePOHWr">Hết hạn trong 2 tuần</span><div class="sc-a137b890-1 joxJgK"><div>', @3@, '</div></div>',
  '<h2 class="sc-1671001a-5 cjuZti">Mô tả công việc</h2><div><div><p>', @1@, '</p></div><div>', @2@, '<div>', @3@, '</div></div></div>',
  '<h2 class="sc-1671001a-5 cjuZti">Yêu cầu công việc</h2><span>skip</span><div><ul><li>', @3@, '</li><li>', @4@, '</li></ul></div>',
  '<div class="sc-c683181c-2 fGxLZh"><div>', @4@, '</div></div><div class="sc-c683181c-2 fGxLZh">', @2@, '</div>',
  '<label>SỐ NĂM KINH NGHIỆM TỐI THIỂU</label><p>', CAST(d.doc_id % 7 AS STRING), '</p><label>NGÀY LÀM VIỆC</label><p>', @4@, '</p>',
  '<label>TỔNG SỐ NGÀY LÀM VIỆC</label><p>5</p>')"""

SECOND_SAYS = """SELECT doc_id AS page_id, p.url AS link, concat(@1@, ' ', @2@, ' Eng') AS title, 'N/A' AS salary, @3@ AS location,
  CAST(d.doc_id % 7 AS VARCHAR) AS experience, concat(@1@, chr(10), @2@, chr(10), @3@) AS description,
  concat(@3@, chr(10), @4@) AS requirements, concat('- ', @4@, chr(10), '- ', @2@, chr(10)) AS benefits,
  @3@ AS work_location_detail, @4@ AS working_time, 'Hạn nộp hồ sơ: 21/10/2025' AS deadline"""

# The same layouts around the lines of a text, each an element of its own.
FIRST_WHOLE = """concat('<title>T | example.com</title><h1 class="b job-detail__info--title">', @1@, '</h1>',
  '<div class="job-description__item"><h3>Mô tả công việc</h3><div class="job-description__item--content">', @PARAGRAPHS@, '<div>x<div>y</div></div>end</div></div>',
  '<div class="job-description__item"><h3>Yêu cầu ứng viên</h3><div class="job-description__item--content">start<ul>', @ITEMS@, '</ul></div></div>',
  '<div class="job-detail__information-detail--actions-label">Hết hạn trong ', CAST(d.doc_id % 30 AS STRING), ' ngày</div>')"""

FIRST_WHOLE_SAYS = """SELECT doc_id AS page_id, p.url AS link, @1@ AS title, '' AS salary, '' AS location, '' AS experience,
  concat(@LINES@, chr(10), 'x', chr(10), 'y', chr(10), 'end') AS description, concat('start', chr(10), @LINES@) AS requirements,
  '' AS benefits, '' AS work_location_detail, '' AS working_time,
  concat('Hạn nộp hồ sơ: ', strftime(DATE '2025-10-07' + CAST(d.doc_id % 30 AS INTEGER), '%d/%m/%Y')) AS deadline"""

SECOND_WHOLE = """concat('<h1>Logo</h1><h1 class="sc-ab270149-0 hAejeW">', @1@, '</h1>',
  '<span class="sc-ab270149-0 ePOHWr">Hết hạn trong 2 tuần</span><div class="sc-a137b890-1 joxJgK"><div>', @3@, '</div></div>',
  '<h2 class="sc-1671001a-5 cjuZti">Mô tả công việc</h2><div>', @PARAGRAPHS@, '<div>end</div></div>',
  '<h2 class="sc-1671001a-5 cjuZti">Yêu cầu công việc</h2><span>skip</span><div>start<ul>', @ITEMS@, '</ul></div>',
  '<div class="sc-c683181c-2 fGxLZh"><div>start', @PARAGRAPHS@, '</div></div><div class="sc-c683181c-2 fGxLZh">', @2@, '</div>',
  '<label>NGÀY LÀM VIỆC</label><p>', @4@, '</p>')"""

SECOND_WHOLE_SAYS = """SELECT doc_id AS page_id, p.url AS link, @1@ AS title, 'N/A' AS salary, @3@ AS location, '' AS experience,
  concat(@LINES@, chr(10), 'end') AS description, concat('start', chr(10), @LINES@) AS requirements,
  concat('- start', chr(10), @LINES@, chr(10), '- ', @2@, chr(10)) AS benefits,
  @3@ AS work_location_detail, @4@ AS working_time, 'Hạn nộp hồ sơ: 21/10/2025' AS deadline"""

# A text in HTML, and its lines without the white space around their ends.
ESCAPED = "replace(replace(replace(coalesce(d.text, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
WHOLE = {
    "@PARAGRAPHS@": f"concat('<p>', replace({ESCAPED}, chr(10), '</p><p>'), '</p>')",
    "@ITEMS@": f"concat('<li>', replace({ESCAPED}, chr(10), '</li><li>'), '</li>')",
    "@LINES@": r"regexp_replace(regexp_replace(coalesce(d.text, ''), '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g'), '^[ \t\r\n]+|[ \t\r\n]+$', '', 'g')",
}


def filled(sql: str, part: str) -> str:
    for i in range(1, 5):
        sql = sql.replace(f"@{i}@", part.format(before=i - 1))
    for mark, whole in WHOLE.items():
        sql = sql.replace(mark, whole)
    return sql


def layout_pages(spark: SparkSession, sf_dir: str, page: str) -> DataFrame:
    """page_id, url and html of a page for every document that has a stored page."""
    sql = f"SELECT d.doc_id AS page_id, p.url, {filled(page, SPARK_PART)} AS html FROM {{d}} d JOIN {{p}} p ON p.page_id = d.doc_id"
    return spark.sql(sql, d=table(spark, sf_dir, "documents"), p=table(spark, sf_dir, "pages"))


def layout_sql(says: str) -> str:
    return filled(says, DUCKDB_PART) + " FROM documents d JOIN pages p ON p.page_id = d.doc_id"
