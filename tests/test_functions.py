import datetime

from pyspark.sql import functions as F

from hirelens.functions import dates, pages, salary, text


def check(evaluate, function, table, **arguments):
    assert evaluate(function, list(table), **arguments) == list(table.values())


def test_normalize_salary(evaluate):
    check(evaluate, salary.normalize_salary, {
        "10 - 20 triệu": 15_000_000,
        "1,000 - 2,000 USD": 36_000_000,
        "Thoả thuận": None,
        "THỎA THUẬN": None,
        "N/A": None,
        "": None,
        None: None,
        "15.000.000 VND": 7,
        "Tới 10.1 triệu": 10_100_000,
        "$ 500": 12_000_000,
        "0 triệu": None,
        "0.5": None,
        "Trên 1000 usd (20 triệu)": 12_240_000,
        "9" * 30: None,
    })


def test_normalize_salary_strict(evaluate):
    check(evaluate, salary.normalize_salary, {
        "15.000.000 VND": 15_000_000,
        "10.000.000 - 20.000.000": 15_000_000,
        "Tới 10.1 triệu": 10_100_000,
        "10.125 triệu": 10_125_000,
        "1.500 USD": 36_000_000,
        "12.5": 12,
    }, mode="strict")


def test_normalize_salary_rate(evaluate):
    assert evaluate(salary.normalize_salary, ["$ 10"], usd_rate=25_000) == [250_000]


def test_salary_band(evaluate):
    band = lambda c: salary.salary_band(c.cast("bigint"))
    check(evaluate, band, {
        "0": "Dưới 5 triệu", "4999999": "Dưới 5 triệu", "5000000": "5 - 10 triệu", "10000000": "10 - 20 triệu",
        "49999999": "20 - 50 triệu", "50000000": "Trên 50 triệu", None: None,
    })


def test_digits_or_null(evaluate):
    check(evaluate, salary.digits_or_null, {"12": 12, " 7 ": 7, "1.5": None, "-3": None, "": None, "1d": None})


def test_parse_deadline(evaluate):
    check(evaluate, dates.parse_deadline, {
        "Hạn nộp hồ sơ: 03/10/2025": datetime.date(2025, 10, 3),
        "3/10/2025": None,
        "103/10/2025": datetime.date(2025, 10, 3),
        "N/A": None,
        "31/02/2025": None,
        None: None,
    })


def test_iso_date(evaluate):
    check(evaluate, dates.iso_date, {"2025-10-03": datetime.date(2025, 10, 3), "": None, " ": None, "x": None, None: None})


def test_relative_deadline(evaluate):
    def on(day):
        return lambda c: dates.resolve_relative_deadline(c, F.to_date(F.lit(day)))

    check(evaluate, on("2025-10-07"), {
        "Hết hạn trong 3 ngày": "Hạn nộp hồ sơ: 10/10/2025",
        "HẾT HẠN TRONG 2 tuần": "Hạn nộp hồ sơ: 21/10/2025",
        "Hết hạn trong 100000 ngày": "Hạn nộp hồ sơ: 23/07/2299",
        "Hết hạn trong 000003 ngày": "Hạn nộp hồ sơ: 10/10/2025",
        "Hết hạn trong 99999999999999999999 ngày": "Hết hạn trong 99999999999999999999 ngày",
        "Hết hạn trong 5 giờ": "Hết hạn trong 5 giờ",
        "Hết hạn trong vài ngày": "Hết hạn trong vài ngày",
        "Hết hạn trong": "Hết hạn trong",
        "Hết hạn trong 999999999 tuần": "Hết hạn trong 999999999 tuần",
        "Hết hạn trong 99999 tháng": "Hết hạn trong 99999 tháng",
        "Hết hạn trong 99999 tuần": "Hạn nộp hồ sơ: 14/04/3942",
        "N/A": "N/A",
        None: None,
    })
    check(evaluate, on("2025-01-31"), {"Hết hạn trong 1 tháng": "Hạn nộp hồ sơ: 28/02/2025"})


def test_clean_requirements(evaluate):
    check(evaluate, text.clean_requirements, {
        "[Required] Python\n Kỹ năng: SQL": "Python",
        "[preferred] Go": "[preferred] Go",
        "Kỹ năng mềm": "Kỹ năng mềm",
        "Go Skill Required: Kafka\nGit": "Go Git",
        "a KỸ NĂNG& b c\nd": "a d",
        "  a\t\x1cb ": "a b",
    })


def test_clean_text(evaluate):
    check(evaluate, text.clean_text, {
        "<p>a</p>\r\n• b – c": "a b c",
        "Scikit-learn": "Scikit learn",
        "a < b": "a < b",
        "★☆x 　y  z": "x y z",
        "": "",
    })


def test_split_sentences(evaluate):
    check(evaluate, text.split_sentences, {
        "A. B! C? D": ["A.", "B!", "C?", "D"],
        "a.b c": ["a.b c"],
        "A. B": ["A.", "B"],
        "": [],
    })


def test_split_cities(evaluate):
    check(evaluate, text.split_cities, {
        "Hà Nội, Đà Nẵng & Huế và Nơi khác": ["Hà Nội", "Đà Nẵng", "Huế"],
        "Hồ Chí Minh, Cần Thơ và 2 nơi khác": ["Hồ Chí Minh", "Cần Thơ"],
        "": [],
        None: [],
    })


def test_small_text_functions(evaluate):
    check(evaluate, text.is_single_city, {"Huế": True, "A & B": False, "A, B": False, "NƠI KHÁC": False, None: None})
    check(evaluate, text.strip_count, {"Python 120": "Python", "C++ ": "C++", "Web 2 x": "Web 2 x", "7": ""})
    check(evaluate, text.strip_parentheses, {"Dev (Remote) (x)": "Dev", "(a) Dev": "Dev", "a (b": "a (b"})
    check(evaluate, text.slug, {"Big Data": "big-data"})
    check(evaluate, text.one_line, {" a\r\nb ": "a  b", None: ""})
    check(evaluate, text.parse_skill_list, {"java ,  SQL,": ["java", "SQL"], "": [], None: []})
    check(evaluate, text.is_usable, {"a": True, " ": False, "a\tb": False, None: False})
    check(evaluate, lambda c: text.default_blank(c, "?"), {" x ": "x", " ": "?", None: "?"})
    check(evaluate, lambda c: text.absolute_url("https://a.b", c), {"/x": "https://a.b/x", "http://c/d": "http://c/d"})


def test_white_space_matches_python(evaluate):
    every = [chr(i) for i in range(0x3100)]
    expected = [c.strip() == "" for c in every]
    assert evaluate(text.is_blank, every) == expected
    assert [x == " " for x in evaluate(lambda c: F.regexp_replace(c, rf"(?U){text.SPACE}", " "), every)] == expected


def test_word_characters_match_python(evaluate):
    # Both sides must know the characters: the newer ones depend on the Unicode version.
    every = [chr(i) for i in (*range(0x860), *range(0x1E00, 0x2070))]
    assert evaluate(lambda c: c.rlike(text.WORD), every) == [c.isalnum() or c == "_" for c in every]


PAGE = """<html><head><title> Data Engineer | jobs.example.com </title></head><body>
<h1 class="t"><a>Data Engineer (Remote)</a></h1>
<h3>Mô tả công việc</h3><div class="c">Build &amp; run<br> pipelines</div>
<h3>YÊU CẦU ứng viên</h3> <div>SQL</div>
<h3>Yêu cầu ứng viên khác</h3><div>Spark</div>
<h3>Khác</h3><div>nothing</div>
<label>NGÀY LÀM VIỆC</label><p>Thứ 2</p>
<ul><li>Laptop</li><li> <b>Lunch</b> </li></ul>
<a target="_blank" href="/brand/x">B</a><a href="https://jobs.example.com/1">J</a></body></html>"""


def test_pages(evaluate):
    from hirelens.fixed_values import DESCRIPTION_LABELS

    def field(name):
        return lambda c: pages.pick_field(pages.headed_pairs(c, pages.opening("h[23]"), pages.opening("div")), name, DESCRIPTION_LABELS)

    assert evaluate(field("description"), [PAGE]) == ["Build & run\npipelines"]
    assert evaluate(field("requirements"), [PAGE]) == ["Spark"]
    assert evaluate(field("benefits"), [PAGE]) == [""]
    days = lambda c: pages.pick_field(
        pages.headed_pairs(c, pages.opening("label"), pages.opening("p")), "days", {"days": "ngày làm việc"})
    assert evaluate(days, [PAGE, "<p>x</p>"]) == ["Thứ 2", ""]
    assert evaluate(pages.bullet_text, [PAGE, ""]) == ["- Laptop\n- Lunch\n", ""]
    assert evaluate(pages.page_links, [PAGE]) == [["/brand/x", "https://jobs.example.com/1"]]
    title = lambda c: pages.posting_title(c, "Example.com")
    assert evaluate(title, [PAGE, "<title>Jobs at example.com</title>", "<title>Cook</title>"]) == [
        "Data Engineer", "(no title)", "Cook"]


def test_relative_deadline_of_any_number(evaluate):
    from hirelens.functions.dates import resolve_relative_deadline

    numbers = ["-9223372036854775808", "9223372036854775807", "-4000001", "99999999999999999999", "4000000"]
    found = [f"hết hạn trong {n} {u}" for n in numbers for u in ("ngày", "tuần", "tháng")]
    assert evaluate(lambda c: resolve_relative_deadline(c, F.to_date(F.lit("2025-10-07"))), found) == found
    assert evaluate(lambda c: resolve_relative_deadline(c, F.to_date(F.lit("2025-10-07"))), ["hết hạn trong -3 ngày"]) == ["Hạn nộp hồ sơ: 04/10/2025"]
