from pyspark.sql import functions as F

from hirelens.operators.pages import extract_postings, first_layout, second_layout

FIRST = """<title>Dev | board.example</title><h1><a>SiteLogo</a></h1><h1 class="job-detail__info--title "><a>Dev <i>x</i> (HN)</a></h1>
<div class="job-detail__info--section"><div class="job-detail__info--section-content-title">Mức lương</div>
 <div class="job-detail__info--section-content-value"> 10 - 20 triệu </div></div>
<div class="job-detail__info--section"><div class="job-detail__info--section-content-title">ĐỊA ĐIỂM</div>
 <div class="job-detail__info--section-content-value">Hà Nội</div></div>
<div class="job-description__item"><h3>Mô tả công việc</h3><div class="job-description__item--content">Build<br>it<div><p>First para.</p><p>Second para.</p></div><ul><li>Python</li><li>Java</li></ul> <b>t</b>ail</div></div>
<div class="job-description__item"><h3>Quyền lợi</h3> <div class="job-description__item--content">Tea &amp; cake</div></div>
<div class="job-detail__information-detail--actions-label">Hạn nộp hồ sơ: 03/10/2025</div>"""

SECOND = """<h1>Logo</h1><h1 class="sc-ab270149-0 hAejeW">Data <span>x</span> Eng</h1><span class="sc-ab270149-0 ePOHWr">Hết hạn trong 3 ngày</span>
<div class="sc-a137b890-1 joxJgK">Huế</div><h2 class="x">Mô tả công việc</h2><div><div>Read</div><div><div>and</div>write</div></div>
<h2>Yêu cầu công việc</h2><span>skip</span><div>SQL</div><h2>Empty</h2><h2>Other</h2><div>none</div><div class="sc-c683181c-2 fGxLZh">Laptop</div><div class="sc-c683181c-2 fGxLZh">Tea</div>
<label>SỐ NĂM KINH NGHIỆM TỐI THIỂU</label><p>2</p><label>NGÀY LÀM VIỆC</label><p>Thứ 2</p>
<label>TỔNG SỐ NGÀY LÀM VIỆC</label><p>5</p>"""


def extract(spark, layout, *pages):
    df = spark.createDataFrame([(f"/{i}", html) for i, html in enumerate(pages)], "url string, html string")
    return [r.asDict() for r in extract_postings(df, layout, F.to_date(F.lit("2025-10-07"))).orderBy("link").collect()]


def test_first_layout(spark):
    blocked = "<title>Just a moment...</title>"
    empty = "<title>Board.Example</title>"
    row, bare = extract(spark, first_layout("board.example"), FIRST, blocked, empty)
    assert row == {
        "title": "Dev x", "link": "/0", "salary": "10 - 20 triệu", "location": "Hà Nội", "experience": "",
        "description": "Build\nit\nFirst para.\nSecond para.\nPython\nJava\ntail", "requirements": "", "benefits": "Tea & cake", "work_location_detail": "",
        "working_time": "", "deadline": "Hạn nộp hồ sơ: 03/10/2025"}
    assert (bare["title"], bare["link"], bare["deadline"]) == ("(no title)", "/2", "")


def test_second_layout(spark):
    row, bare = extract(spark, second_layout("board.example"), SECOND, "<p>x</p>")
    assert row == {
        "title": "Data x Eng", "link": "/0", "salary": "N/A", "location": "Huế", "experience": "2",
        "description": "Read\nand\nwrite", "requirements": "SQL", "benefits": "- Laptop\n- Tea\n", "work_location_detail": "Huế",
        "working_time": "Thứ 2", "deadline": "Hạn nộp hồ sơ: 10/10/2025"}
    assert (bare["title"], bare["salary"], bare["benefits"]) == ("N/A", "N/A", "")


def test_elements_end_at_the_matching_tag(spark):
    from hirelens.functions import pages

    html = ['<div class="a">x<div>y<div/>z</div>w</div>rest', '<p class="a">open', '<DIV CLASS="b a c"><div>1</div><DIV>2</DIV></DIV>3', "none", ""]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(html)], "i int, h string")
    start = pages.from_first(F.col("h"), pages.opening(style="a"))
    found = [r.c for r in df.orderBy("i").select(F.when(start.isNotNull(), pages.element(start)["content"]).alias("c")).collect()]
    # `<div/>` opens an element in HTML; the last of the three is then closed by nothing.
    assert found == ["x<div>y<div/>z</div>w</div>rest", "open", "<div>1</div><DIV>2</DIV>", None, None]
