"""The same results in plain SQL for DuckDB.

The logic is written without the library. The long lists that both sides must share (skill terms, bullets, white space,
constraints of the model) are taken from it.
"""

from __future__ import annotations

from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions.text import BULLETS, SPACE_CHARS
from hirelens.schemas import FLAT_FIELDS, FOREIGN_KEYS, JOB_FIELDS, MAX_LENGTHS, REQUIRED, UNIQUE_KEYS
from workload.layouts import FIRST_SAYS, FIRST_WHOLE_SAYS, SECOND_SAYS, SECOND_WHOLE_SAYS, layout_sql
from workload.postings import CRAWL_DATE, duckdb_view
from workload.queries import SECTION_WORDS, WORDS

WORD = r"[\p{L}\p{N}_]"
SPACES = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# ---- scalar pieces


def strip(x: str) -> str:
    return f"trim({x}, {quoted(SPACE_CHARS)})"


def usable(x: str) -> str:
    return f"({strip(x)} <> '' AND NOT contains({x}, chr(9)))"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, '{SPACES}+', ' ', 'g')")


def default_blank(x: str, default: str) -> str:
    return f"coalesce(nullif({strip(x)}, ''), {quoted(default)})"


def salary_of(x: str, strict: bool = False) -> str:
    text = f"replace(lower({x}), ',', '')"
    read = text
    if strict:
        # Each pass joins every other pair of digit groups.
        joined = text
        for _ in range(2):
            joined = rf"regexp_replace({joined}, '(\d)\.(\d\d\d)\b', '\1\2', 'g')"
        read = f"(CASE WHEN contains({text}, 'triệu') THEN {text} ELSE {joined} END)"
    numbers = rf"[CAST(n AS DOUBLE) FOR n IN regexp_extract_all({read}, '\d+(?:\.\d+)?')]"
    factor = (f"(CASE WHEN contains({text}, 'usd') OR contains({text}, '$') THEN 24000 "
              f"WHEN contains({text}, 'triệu') THEN 1000000 ELSE 1 END)")
    amount = f"CAST(trunc(list_sum({numbers}) / len({numbers}) * {factor}) AS BIGINT)"
    return (f"(CASE WHEN contains(lower({x}), 'thoả thuận') OR contains(lower({x}), 'thỏa thuận') "
            f"OR len({numbers}) = 0 THEN NULL WHEN {amount} > 0 THEN {amount} END)")


def deadline_of(x: str) -> str:
    found = rf"regexp_extract({x}, '\d\d/\d\d/\d\d\d\d')"
    return f"strftime(try_strptime(nullif({found}, ''), '%d/%m/%Y'), '%Y-%m-%d')"


def requirements_of(x: str) -> str:
    untagged = rf"regexp_replace({x}, '\[(Required|Preferred)\]', '', 'g')"
    return collapse(rf"regexp_replace({untagged}, '(?i-s)\b(Skill Required|Kỹ năng[:&]).*', '', 'g')")


def cleaned_text(x: str) -> str:
    bare = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    return collapse(f"regexp_replace({bare}, {quoted(BULLETS)}, ' ', 'g')")


def sentences_of(x: str) -> str:
    marked = rf"regexp_replace({x}, '([.!?]){SPACES}+', '\1' || chr(1), 'g')"
    return f"[{strip('s')} FOR s IN string_split({marked}, chr(1)) IF {strip('s')} <> '']"


def cities_of(x: str) -> str:
    parts = f"string_split_regex(coalesce({x}, ''), '[,&]| và ')"
    return f"[{strip('p')} FOR p IN {parts} IF {strip('p')} <> '' AND NOT contains(lower(p), 'khác')]"


def one_city(x: str) -> str:
    return f"(NOT contains({x}, '&') AND NOT contains({x}, ',') AND NOT contains(lower({x}), 'nơi khác'))"


def skill_list(x: str) -> str:
    return f"[{strip('s')} FOR s IN string_split({x}, ',') IF {strip('s')} <> '']"


def relative(x: str, day: str) -> str:
    rest = strip(f"replace(lower({strip(x)}), 'hết hạn trong', '')")
    n = rf"TRY_CAST(regexp_extract({rest}, '^([+-]?\d+)\s', 1) AS INTEGER)"
    unit = rf"regexp_extract({rest}, '^[+-]?\d+\s+(\S+)', 1)"
    later = (f"(CASE WHEN {n} IS NULL THEN NULL WHEN contains({unit}, 'ngày') THEN {day} + to_days({n}) "
             f"WHEN contains({unit}, 'tuần') THEN {day} + to_days(7 * {n}) "
             f"WHEN contains({unit}, 'tháng') THEN {day} + to_months({n}) END)")
    return (f"CASE WHEN contains(lower({x}), 'hết hạn trong') THEN "
            f"coalesce('Hạn nộp hồ sơ: ' || strftime({later}, '%d/%m/%Y'), {x}) ELSE {x} END")


def rendered(x: str) -> str:
    tags = r"(?i)<br\s*/?>|</?(?:p|div|ul|ol|li|h[1-6]|table|tr|section|article|header|footer)\b[^>]*>"
    text = f"regexp_replace(regexp_replace({x}, '{tags}', chr(10), 'g'), '<[^>]+>', '', 'g')"
    text = rf"regexp_replace({text}, '[ \t\r]*\n[ \t\r\n]*', chr(10), 'g')"
    for entity, char in (("&nbsp;", "chr(160)"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"),
                         ("&#39;", "chr(39)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{entity}', {char})"
    return strip(text)


TITLE = r"'(?is)<title[^>]*>(.*?)</title>'"
LINK = r"""'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'"""


SECTION = r"'(?is)<b>(.*?)<br>\s*<p>(.*?)</p>'"
LINK_WORDS = {"salary": "der", "location": "que"}


def title_of(html: str) -> str:
    headline = rendered(f"regexp_extract({html}, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
    page = rendered(f"regexp_extract({html}, {TITLE}, 1)")
    plain = strip(rf"regexp_replace({headline}, '\s*\(.*?\)', '', 'g')")
    return (f"CASE WHEN contains({html}, '<h1') THEN {plain} "
            f"WHEN contains(lower({page}), 'example.com') THEN '(no title)' ELSE {page} END")


def bullets(html: str) -> str:
    items = f"regexp_extract_all({html}, '(?is)<li[^>]*>(.*?)</li>', 1)"
    return f"coalesce(array_to_string(['- ' || {rendered('i')} || chr(10) FOR i IN {items}], ''), '')"


def both(pattern: str) -> str:
    return f"list_zip(regexp_extract_all(html, {pattern}, 1), regexp_extract_all(html, {pattern}, 2))"


def picked(pairs: str, name: str, words: dict[str, str], label: int, value: int) -> str:
    """Value of the last pair whose label's first matching word belongs to the field."""
    owner = " ".join(f"WHEN contains(lower({rendered(f'p[{label}]')}), {quoted(w)}) THEN {quoted(f)}" for f, w in words.items())
    return f"coalesce([{rendered(f'p[{value}]')} FOR p IN {pairs} IF CASE {owner} END = {quoted(name)}][-1], '')"


# ---- shared tables

CTES = {
    "postings": duckdb_view(),
    "flat": f"SELECT *, {salary_of('salary')} AS salary_normalized FROM postings",
    "cleaned": f"""SELECT job_id, grp, title, link, location, experience, description,
        {requirements_of('requirements')} AS requirements, benefits, location AS work_location_detail,
        {default_blank('working_time', 'Không rõ')} AS working_time, {deadline_of('deadline')} AS deadline,
        salary AS salary_raw, salary_normalized,
        CASE WHEN salary_normalized IS NOT NULL THEN 'VND' END AS currency_unit,
        {skill_list('skills')} AS skills FROM flat""",
    "skill_rows": "SELECT DISTINCT job_id, grp, unnest(skills) AS name FROM cleaned",
    "groups": "SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT grp AS name FROM cleaned)",
    "skill_dim": "SELECT row_number() OVER (ORDER BY name) AS id, name FROM (SELECT DISTINCT name FROM skill_rows)",
    "city_rows": f"SELECT grp, experience, salary_normalized, unnest({cities_of('location')}) AS city FROM flat",
    "blocks": """SELECT crawl_date, source, grp, job_id // 500 AS part, count(*) AS n FROM postings GROUP BY ALL""",
    "block_years": """SELECT strftime(date_trunc('year', crawl_date), '%Y-%m-%d') AS crawl_year, p.*,
        row_number() OVER (PARTITION BY date_trunc('year', crawl_date), source, grp, job_id // 500 ORDER BY job_id) - 1 AS pos
        FROM postings p""",
    "lexicon": "SELECT unnest([" + ", ".join(quoted(s.lower()) for s in dict.fromkeys(SKILL_LEXICON)) + "]) AS term",
    # Every place in every different text, compared with every term.
    "text_spans": f"""SELECT DISTINCT requirements, place - 1 AS s, place - 1 + length(term) AS e
        FROM (SELECT requirements, unnest(generate_series(1, length(requirements))) AS place
              FROM (SELECT DISTINCT requirements FROM postings)) p, lexicon
        WHERE lower(substr(requirements, place, length(term))) = term
          AND regexp_matches(substr(requirements, place, 1), '{WORD}')
              <> (place > 1 AND regexp_matches(substr(requirements, place - 1, 1), '{WORD}'))
          AND regexp_matches(substr(requirements, place + length(term) - 1, 1), '{WORD}')
              <> regexp_matches(substr(requirements, place + length(term), 1), '{WORD}')""",
    "text_tags": """SELECT requirements, list_reduce(list([{'s': s, 'e': e}] ORDER BY s, e),
        lambda kept, one: CASE WHEN one[1].s >= kept[-1].e THEN list_concat(kept, one) ELSE kept END) AS tags
        FROM text_spans GROUP BY requirements""",
    "texts": f"SELECT doc_id, {cleaned_text('text')} AS cleaned FROM documents",
    "sentence_rows": f"SELECT doc_id, unnest({sentences_of('cleaned')}) AS sentence, "
                     f"generate_subscripts({sentences_of('cleaned')}, 1) - 1 AS pos FROM texts",
}


def token_spans(table: str, key: str, text: str) -> str:
    """Spans of the word lexicon by walking over tokens: words and the gaps between them."""
    tests = []
    for term in WORDS:
        words = term.split(" ")
        test, end = f"t0 = {quoted(words[0])}", "n0"
        if len(words) == 2:
            test, end = f"{test} AND t1 = ' ' AND t2 = {quoted(words[1])}", "n0 + 1 + n2"
        tests.append(f"SELECT key, place AS s, place + {end} AS e FROM tokens WHERE {test}")
    return f"""tokens AS (
        SELECT key, lower(t) AS t0, length(t) AS n0, lead(t) OVER w AS t1, lower(lead(t, 2) OVER w) AS t2,
               length(lead(t, 2) OVER w) AS n2,
               coalesce(sum(length(t)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
        FROM (SELECT {key} AS key, unnest(all_tokens) AS t, generate_subscripts(all_tokens, 1) AS i
              FROM (SELECT {key}, regexp_extract_all({text}, '{WORD}+|[^\\p{{L}}\\p{{N}}_]+') AS all_tokens FROM {table}))
        WINDOW w AS (PARTITION BY key ORDER BY i)),
      word_spans AS ({' UNION '.join(tests)})"""


def tokens_of(text: str) -> str:
    return f"regexp_extract_all({text}, '{WORD}+|[^\\p{{L}}\\p{{N}}_]+')"


def spans_by_tokens(texts: str, terms: str, most: int) -> str:
    """Spans of terms of up to `most` tokens as runs of whole tokens: every run of every text against every term."""
    runs = " UNION ALL ".join(
        f"SELECT doc_id, place, first, {' || '.join(['t0', *[f't{k}' for k in range(1, n)]])} AS run, {f't{n - 1}'} AS last, t{n} AS beyond FROM wide"
        for n in range(1, most + 1))
    leads = ", ".join(f"lead(low, {k}) OVER w AS t{k}" for k in range(1, most + 1))
    return f"""WITH texts AS ({texts}), terms AS (SELECT DISTINCT lower(term) AS term FROM ({terms}) WHERE length(term) > 0),
      tokens AS (SELECT r, doc_id, unnest(t) AS t, generate_subscripts(t, 1) AS i
        FROM (SELECT row_number() OVER () AS r, doc_id, {tokens_of('text')} AS t FROM texts)),
      wide AS (SELECT doc_id, low AS t0, {leads}, sum(length(low)) OVER w - length(low) AS place, i = 1 AS first
        FROM (SELECT r, doc_id, i, lower(t) AS low FROM tokens) WINDOW w AS (PARTITION BY r ORDER BY i)),
      runs AS ({runs})
      SELECT doc_id, CAST(place AS INTEGER) AS start_at, CAST(place + length(run) AS INTEGER) AS end_at FROM runs JOIN terms ON term = run
      WHERE (regexp_matches(run, '^{WORD}') OR NOT first) AND (regexp_matches(last, '^{WORD}') OR beyond IS NOT NULL)"""


PLANTED = """array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: x || ' ' || {terms}[(((i - 1) * 7 + doc_id) % {n}) + 1]
    || CASE WHEN (i - 1) % 3 = 0 THEN '.' ELSE ' ' END), chr(10))"""
ALL_TERMS = "[" + ", ".join(quoted(t) for t in SKILL_LEXICON) + "]"
LEXICON_IN_DOCUMENTS = spans_by_tokens(
    f"SELECT doc_id, {PLANTED.format(terms=ALL_TERMS, n=len(SKILL_LEXICON))} AS text FROM documents", f"SELECT unnest({ALL_TERMS}) AS term", 5)
ITEM_WORDS = "SELECT string_split(trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')), ' ') AS w FROM benchmark"
LEXICON_TABLE = spans_by_tokens(
    "SELECT doc_id, text FROM documents WHERE text IS NOT NULL",
    f"SELECT unnest(w) AS term FROM ({ITEM_WORDS}) UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM ({ITEM_WORDS}), unnest(range(1, len(w))) AS s(i) WHERE lower(w[i]) <> lower(w[i + 1])", 3)


def sql(body: str, *ctes: str, extra: str = "") -> str:
    """A statement with the shared tables it needs, given in the order they build on each other."""
    parts = [f"{name} AS ({CTES[name]})" for name in ctes]
    if extra:
        parts.append(extra)
    return f"WITH {', '.join(parts)} {body}" if parts else body


def star(body: str) -> str:
    return sql(body, "postings", "flat", "cleaned", "skill_rows", "groups", "skill_dim")


JOBS = """SELECT job_id AS id, g.id AS group_id, title, link, location, experience, work_location_detail,
    working_time, deadline, salary_raw, salary_normalized, currency_unit FROM cleaned JOIN groups g ON g.name = grp"""


# The posting as a JSON object of its columns in the order of their names.
KEY_COLUMNS = sorted({"group", "source", "crawl_date", "skills", *JOB_FIELDS})
KEY_VALUES = {"group": "grp", "crawl_date": "strftime(crawl_date, '%Y-%m-%d')", "work_location_detail": "location"}
KEY_PARTS = " || ',' || ".join(f"""'"{c}":' || coalesce(CAST(to_json({KEY_VALUES.get(c, c)}) AS VARCHAR), 'null')""" for c in KEY_COLUMNS)
JOB_KEY_ROWS = f"""SELECT DISTINCT md5('{{' || {KEY_PARTS} || '}}') AS job_id, grp AS "group", link, title, salary FROM postings"""


def one_line(x: str) -> str:
    return strip(f"replace(replace(coalesce({x}, ''), chr(10), ' '), chr(13), ' ')")


def flat_columns() -> str:
    special = {
        "group": one_line("grp"),
        "salary_normalized": "coalesce(CAST(salary_normalized AS VARCHAR), '')",
        "currency_unit": "coalesce(currency_unit, '')",
        "skills": "array_to_string(skills, ', ')",
    }
    return ", ".join(f'{special.get(c, one_line(c))} AS "{c}"' for c in FLAT_FIELDS)


def search_columns(joins: str, where: str) -> str:
    def shown(c: str) -> str:
        return f"coalesce(nullif({c}, ''), 'Không có') AS {c}"

    return f"""SELECT c.job_id AS id, title, location, experience, working_time, deadline, salary_raw, salary_normalized,
        c.grp AS group_name, {shown('description')}, {shown('requirements')}, {shown('benefits')},
        coalesce(l.skills, '') AS skills
        FROM cleaned c LEFT JOIN (SELECT job_id, string_agg(name, '|' ORDER BY name) AS skills
                                  FROM skill_rows GROUP BY job_id) l ON l.job_id = c.job_id {joins} {where}"""


REJOINED = """SELECT * EXCLUDE (grp, skills), grp AS "group",
        array_to_string(list_sort(list_distinct(skills)), '|') AS skills FROM cleaned"""

BLOCK_ROWS = ('SELECT crawl_year AS crawl_date, grp AS "group", source, CAST(pos AS INTEGER) AS pos, '
              + ", ".join("location AS work_location_detail" if f == "work_location_detail" else f for f in JOB_FIELDS)
              + " FROM block_years")

CLEAN = """SELECT * EXCLUDE (grp, skills, tags, cleaned_requirements), grp AS "group",
        coalesce(array_to_string([substr(c.requirements, CAST(t.s AS BIGINT) + 1, CAST(t.e - t.s AS BIGINT)) FOR t IN tags], '|'), '') AS skills
        FROM cleaned c LEFT JOIN (SELECT requirements AS cleaned_requirements, tags FROM text_tags) x
        ON x.cleaned_requirements = c.requirements"""


def tagged(select: str, *more: str) -> str:
    """The library tags the cleaned requirements, so the places are searched in those."""
    return sql(select, "postings", "flat", "cleaned", "lexicon", *more,
               extra="text_spans AS (" + CTES["text_spans"].replace("FROM postings", "FROM cleaned") + "), text_tags AS ("
                     + CTES["text_tags"] + ")")


def ingested(turn: str = "crawl_year", where: str = "true") -> str:
    """All columns of the copy that the day ingested first brought: by source, place in the block, then the fields."""
    fields = ", ".join(f"{'location' if f == 'work_location_detail' else f} NULLS FIRST" for f in JOB_FIELDS)
    return tagged(f"""SELECT w.crawl_date, w.source, x.* EXCLUDE (job_id) FROM ({CLEAN}) x JOIN (
        SELECT job_id, crawl_year AS crawl_date, source FROM block_years
        QUALIFY row_number() OVER (PARTITION BY grp, link ORDER BY {turn}, source, pos, {fields}) = 1) w USING (job_id)
        WHERE {where}""", "block_years")


def found_jobs(where: str) -> str:
    return star(search_columns("", "WHERE " + where).replace("'|'", "', '"))


def kv_lines(key: str, value: str) -> str:
    line = strip(f"coalesce({key}, '') || chr(9) || coalesce(CAST({value} AS VARCHAR), '')")
    return f"SELECT string_split({line}, chr(9)) AS parts FROM postings"


def violations(again: str = "true", kept: str = "true") -> str:
    """Every constraint counted over the model without the Python skills, with the jobs of group 1 where `again` holds twice, and
    with those skills of jobs for which `kept` holds."""
    model = f""", jobs_once AS ({JOBS}),
      m_skill_groups AS (SELECT * FROM groups),
      m_skills AS (SELECT * FROM skill_dim WHERE NOT contains(lower(name), 'python')),
      m_skill_details AS (SELECT DISTINCT s.id AS skill_id, g.id AS group_id FROM skill_rows r
        JOIN skill_dim s ON s.name = r.name JOIN groups g ON g.name = r.grp),
      m_jobs AS (SELECT * FROM jobs_once UNION ALL SELECT * FROM jobs_once WHERE group_id = 1 AND {again}),
      m_job_details AS (SELECT job_id AS id, job_id FROM cleaned),
      m_job_skills AS (SELECT job_id, s.id AS skill_id FROM skill_rows r JOIN skill_dim s ON s.name = r.name WHERE {kept})"""
    counts = []
    for table, keys in UNIQUE_KEYS.items():
        for key in keys:
            columns = ", ".join(key)
            counts.append(("unique", f"{table}({columns})",
                           f"(SELECT {columns} FROM m_{table} GROUP BY {columns} HAVING count(*) > 1)"))
    for child, column, parent, _ in FOREIGN_KEYS:
        counts.append(("foreign key", f"{child}.{column}",
                       f"m_{child} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT id FROM m_{parent})"))
    for table, columns in REQUIRED.items():
        counts.append(("required", table, f"m_{table} WHERE " + " OR ".join(f"{c} IS NULL" for c in columns)))
    for table, limits in MAX_LENGTHS.items():
        counts.append(("length", table, f"m_{table} WHERE " + " OR ".join(f"length({c}) > {n}" for c, n in limits.items())))
    return star(model + " UNION ALL ".join(
        f" SELECT {quoted(rule)} AS rule, {quoted(subject)} AS subject, count(*) AS offending_rows FROM {rows}"
        for rule, subject, rows in counts))


def cube(where: str = "") -> str:
    """Where cities are summed over, a posting counts once, however many cities it names."""
    return sql(
        'SELECT grp AS "group", city, experience, CAST(grouping_id(grp, city, experience) AS INTEGER) AS level, '
        "count(*) AS postings, avg(salary_normalized) AS avg_salary_vnd "
        f"FROM (SELECT grp, experience, salary_normalized, unnest(CASE WHEN len({cities_of('location')}) = 0 "
        f"THEN [NULL] ELSE {cities_of('location')} END) AS city FROM flat {where}) "
        "GROUP BY GROUPING SETS ((grp, city, experience), (grp, city), (city, experience), (city)) "
        'UNION ALL SELECT grp, NULL, experience, CAST(4 * grouping(grp) + 2 + grouping(experience) AS INTEGER), count(*), '
        f"avg(salary_normalized) FROM flat {where} GROUP BY CUBE (grp, experience)",
        "postings", "flat")


ORACLES: dict[str, str] = {
    "check_model": violations(),
    # What the even jobs hold breaks no rule, so all that is broken comes from the addition.
    "check_added": violations("id % 2 = 0", "job_id % 2 = 1 OR NOT contains(lower(s.name), 'python')"),
    "derived_postings": sql(
        """SELECT * EXCLUDE (grp, crawl_date), grp AS "group", location AS work_location_detail,
        strftime(crawl_date, '%Y-%m-%d') AS crawl_date FROM postings""", "postings"),
    # analyses
    "jobs_high_salary": sql(
        f"SELECT {strip('title')} AS title, salary_normalized AS salary_vnd FROM flat "
        f"WHERE salary_normalized >= 10000000 AND {usable('title')}", "postings", "flat"),
    "jobs_in_cities": sql(
        f"SELECT {strip('title')} AS title, lower({strip('location')}) AS location FROM postings "
        "WHERE (contains(lower(location), 'hà nội') OR contains(lower(location), 'ho chi minh') "
        f"OR contains(lower(location), 'hồ chí minh')) AND {usable('title')}", "postings"),
    "jobs_no_experience": sql(
        f"SELECT {strip('title')} AS title, lower({strip('experience')}) AS experience FROM postings "
        r"WHERE (contains(lower(experience), 'không yêu cầu') OR regexp_extract(experience, '\d+') = '0') "
        f"AND {usable('title')}", "postings"),
    "jobs_with_skill": sql(
        f"SELECT {strip('title')} AS title, array_to_string([{strip('s')} FOR s IN string_split(lower(skills), ',')], ', ') "
        f"AS skills FROM postings WHERE contains(lower(skills), 'python') AND {usable('title')}", "postings"),
    "avg_salary_by_city": sql(
        f"SELECT {strip('location')} AS city, avg(salary_normalized) AS avg_salary_vnd, count(*) AS postings FROM flat "
        f"WHERE salary_normalized IS NOT NULL AND {one_city('location')} AND {usable('location')} GROUP BY 1",
        "postings", "flat"),
    "top_paid_jobs": sql(
        f"SELECT {strip('title')} AS title, salary_normalized AS salary_vnd FROM flat "
        f"WHERE salary_normalized IS NOT NULL AND {usable('title')} ORDER BY salary_vnd DESC, 1 DESC LIMIT 10",
        "postings", "flat"),
    "postings_by_group": sql('SELECT grp AS "group", count(*) AS postings FROM postings GROUP BY 1', "postings"),
    "postings_by_city": sql("SELECT city, count(*) AS postings FROM city_rows GROUP BY 1", "postings", "flat", "city_rows"),
    "top_cities": sql("SELECT city, count(*) AS postings FROM city_rows GROUP BY 1 ORDER BY postings DESC, city LIMIT 10",
                      "postings", "flat", "city_rows"),
    "market_cube": cube(),
    "kept_cube": cube(),
    "kept_cube_range": cube("WHERE year(crawl_date) BETWEEN 1993 AND 1997"),
    # profile
    "profile_overview": sql(
        f"SELECT source, CAST(grouping(source) AS INTEGER) AS level, count(*) AS postings, {quoted(', '.join(['group', 'source', *JOB_FIELDS]))} AS columns "
        "FROM postings GROUP BY ROLLUP (source)", "postings"),
    "value_counts_location": sql(
        "SELECT coalesce(nullif(location, ''), 'Không rõ') AS location, count(*) AS postings FROM postings GROUP BY 1",
        "postings"),
    "value_counts_salary": sql(
        "SELECT salary, count(*) AS postings FROM postings WHERE salary IS NOT NULL GROUP BY 1", "postings"),
    "top_locations": sql(
        "SELECT coalesce(nullif(location, ''), 'Không rõ') AS location, count(*) AS postings FROM postings GROUP BY 1 "
        "ORDER BY 2 DESC, 1 LIMIT 10", "postings"),
    "top_salaries": sql(
        "SELECT salary, count(*) AS postings FROM postings WHERE salary IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        "postings"),
    # column functions over postings
    "normalize_salary": sql(
        f"SELECT job_id, salary, salary_normalized AS amount, {salary_of('salary', strict=True)} AS amount_strict, "
        "CASE WHEN salary_normalized IS NOT NULL THEN 'VND' END AS unit FROM flat", "postings", "flat"),
    "parse_deadline": sql(f"SELECT job_id, deadline, {deadline_of('deadline')} AS day FROM postings", "postings"),
    "relative_deadline": sql(
        f"SELECT job_id, {relative('deadline', f'DATE {quoted(CRAWL_DATE)}')} AS from_fixed_day, "
        f"{relative('deadline', 'crawl_date')} AS from_crawl_day FROM postings", "postings"),
    "iso_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "clean_requirements": sql(f"SELECT job_id, {requirements_of('requirements')} AS cleaned FROM postings", "postings"),
    "title_cleanup": sql(rf"SELECT job_id, {strip(r'''regexp_replace(title, '\s*\(.*?\)', '', 'g')''')} AS title FROM postings",
                         "postings"),
    "label_cleanup": r"SELECT p_partkey, trim(regexp_replace(p_type || ' ' || p_size, '\s*\d+$', '')) AS label FROM part",
    "default_blanks": sql(
        f"SELECT job_id, {default_blank('working_time', 'Không rõ')} AS working_time, "
        f"{default_blank('location', 'Không rõ')} AS location, {default_blank('benefits', 'N/A')} AS benefits FROM postings",
        "postings"),
    # The library tags the cleaned requirements, so the places are searched in those.
    "clean_postings": tagged(CLEAN),
    # text and skills
    "clean_text": sql("SELECT doc_id, cleaned FROM texts", "texts"),
    "sentences": sql("SELECT doc_id, CAST(pos AS INTEGER) AS pos, sentence FROM sentence_rows", "texts", "sentence_rows"),
    "skill_spans": sql(
        "SELECT job_id, CAST(s AS INTEGER) AS start_at, CAST(e AS INTEGER) AS end_at FROM postings JOIN text_spans USING (requirements)",
        "postings", "lexicon", "text_spans"),
    "tag_skills": sql(
        """SELECT job_id, coalesce(array_to_string([substr(requirements, CAST(t.s AS BIGINT) + 1, CAST(t.e - t.s AS BIGINT))
        FOR t IN tags], '|'), '') AS skills FROM postings LEFT JOIN text_tags USING (requirements)""",
        "postings", "lexicon", "text_spans", "text_tags"),
    "non_overlapping_spans": sql(
        """SELECT key AS doc_id, CAST(t.s AS INTEGER) AS start_at, CAST(t.e AS INTEGER) AS end_at
        FROM (SELECT key, unnest(list_reduce(list([{'s': s, 'e': e}] ORDER BY s, e),
          lambda kept, one: CASE WHEN one[1].s >= kept[-1].e THEN list_concat(kept, one) ELSE kept END)) AS t
          FROM word_spans GROUP BY key)""",
        "texts", extra=token_spans("texts", "doc_id", "cleaned")),
    "lexicon_in_documents": LEXICON_IN_DOCUMENTS,
    "lexicon_table": LEXICON_TABLE,
    "label_sentences": sql(
        "SELECT key AS text, CAST(s AS INTEGER) AS start_at, CAST(e AS INTEGER) AS end_at, 'SKILL' AS label FROM word_spans",
        "texts", "sentence_rows",
        extra="distinct_sentences AS (SELECT DISTINCT sentence FROM sentence_rows), "
              + token_spans("distinct_sentences", "sentence", "sentence")),
    # pages
    "pages_not_blocked": f"SELECT page_id, url FROM pages WHERE NOT contains(lower({rendered(f'regexp_extract(html, {TITLE}, 1)')}), 'de')",
    "pages_link_filter": f"""SELECT page_id, CAST(pos AS INTEGER) AS pos, link FROM (
        SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS pos
        FROM (SELECT page_id, regexp_extract_all(html, {LINK}, 1) AS links FROM pages)) WHERE NOT contains(link, '/th')""",
    "group_filter": sql("""SELECT job_id, grp AS "group" FROM postings WHERE grp = 'BUILDING'""", "postings"),
    "page_titles": f"SELECT page_id, {title_of('html')} AS title FROM pages",
    "first_layout": layout_sql(FIRST_SAYS),
    "second_layout": layout_sql(SECOND_SAYS),
    "first_layout_whole": layout_sql(FIRST_WHOLE_SAYS),
    "second_layout_whole": layout_sql(SECOND_WHOLE_SAYS),
    "page_sections": f"""SELECT page_id, {', '.join(f"{picked('pairs', f, SECTION_WORDS, 1, 2)} AS {f}" for f in SECTION_WORDS)}
        FROM (SELECT page_id, {both(SECTION)} AS pairs FROM pages)""",
    "page_lists": f"SELECT page_id, {bullets('html')} AS bullets FROM pages",
    "extract_postings": f"""SELECT page_id, url AS link, {title_of('html')} AS title,
        {', '.join(f"{picked('sections', f, SECTION_WORDS, 1, 2)} AS {f}" for f in SECTION_WORDS)},
        {picked('links', 'salary', LINK_WORDS, 2, 1)} AS salary, {picked('links', 'location', LINK_WORDS, 2, 1)} AS location,
        {picked('links', 'location', LINK_WORDS, 2, 1)} AS work_location_detail, 'N/A' AS experience,
        {bullets('html')} AS working_time,
        CASE WHEN contains(html, '<footer>') THEN {rendered("regexp_extract(html, '(?is)<footer>(.*?)</footer>', 1)")}
          ELSE 'N/A' END AS deadline
        FROM (SELECT page_id, url, html, {both(SECTION)} AS sections, {both(LINK)} AS links FROM pages
              WHERE NOT contains(lower({rendered(f'regexp_extract(html, {TITLE}, 1)')}), 'just a moment'))""",
    "url_slug": f"""SELECT page_id, CAST(pos AS INTEGER) AS pos, slug,
        CASE WHEN starts_with(link, 'http') THEN link ELSE 'https://jobs.example.com' || link END AS url
        FROM (SELECT page_id, slug, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS pos
          FROM (SELECT page_id, regexp_extract_all(html, {LINK}, 1) AS links,
                replace(lower({rendered(f'regexp_extract(html, {TITLE}, 1)')}), ' ', '-') AS slug FROM pages))""",
    # which postings to keep
    "union_sources": sql(
        """SELECT job_id, source, title, CASE WHEN source = 'board_a' THEN salary END AS salary,
        CASE WHEN source = 'board_b' THEN location END AS location FROM postings""", "postings"),
    "dedup_links": sql(
        """SELECT job_id, grp AS "group", link, title FROM postings
        QUALIFY row_number() OVER (PARTITION BY grp, link ORDER BY job_id) = 1""", "postings"),
    "new_links": sql(
        """SELECT min(job_id) AS job_id, grp AS "group", link FROM postings GROUP BY grp, link
        HAVING min(crawl_date) >= DATE '1996-01-01'""", "postings"),
    "cap_per_group": sql(
        """SELECT job_id, grp AS "group" FROM postings
        QUALIFY row_number() OVER (PARTITION BY grp ORDER BY job_id) <= 500""", "postings"),
    # relational model
    "dim_groups": star("SELECT id, name FROM groups"),
    "dim_skills": star("SELECT id, name FROM skill_dim"),
    "dim_skills_case_blind": star(
        """SELECT row_number() OVER (ORDER BY name) AS id, name
        FROM (SELECT min(name) AS name FROM skill_rows GROUP BY lower(name))"""),
    "dim_parts": """SELECT row_number() OVER (ORDER BY name) AS id, name
        FROM (SELECT DISTINCT p_name || ' ' || p_type AS name FROM part)""",
    "skill_details": star(
        """SELECT DISTINCT s.id AS skill_id, g.id AS group_id FROM skill_rows r
        JOIN skill_dim s ON s.name = r.name JOIN groups g ON g.name = r.grp"""),
    "load_jobs": star(JOBS),
    "load_job_details": star("SELECT job_id AS id, job_id, description, requirements, benefits FROM cleaned"),
    "job_skills": star("SELECT job_id, s.id AS skill_id FROM skill_rows r JOIN skill_dim s ON s.name = r.name"),
    "upsert_dimension": star(
        """SELECT id, name FROM skill_dim UNION ALL
        SELECT (SELECT max(id) FROM skill_dim) + row_number() OVER (ORDER BY name), name
        FROM (SELECT DISTINCT p_brand AS name FROM part WHERE p_brand NOT IN (SELECT name FROM skill_dim))"""),
    "job_keys": sql(
        """SELECT grp AS "group", count(*) AS jobs FROM (SELECT DISTINCT grp, link, title, salary FROM postings) GROUP BY 1""",
        "postings"),
    "job_key_rows": sql(JOB_KEY_ROWS, "postings"),
    "read_ungrouped": sql(f"""SELECT CAST(NULL AS VARCHAR) AS "group", {', '.join(JOB_FIELDS)}
        FROM (SELECT *, location AS work_location_detail FROM postings)""", "postings"),
    "broken_blocks": sql("""SELECT DISTINCT strftime(date_trunc('year', crawl_date), '%Y-%m-%d') AS crawl_date, source, true AS has_record
        FROM postings WHERE source = 'board_b'""", "postings"),
    "star_rejoin": star(REJOINED),
    "load_star_again": star(REJOINED),
    "star_ids_stay": star("SELECT 'skill_groups' AS kind, name, true AS stays FROM groups UNION ALL SELECT 'skills', name, true FROM skill_dim"),
    # constraints
    "check_unique": sql(
        'SELECT grp AS "group", link, count(*) AS copies FROM postings GROUP BY ALL HAVING count(*) > 1', "postings"),
    "check_foreign_keys": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    "check_lengths": sql(
        "SELECT job_id, title FROM postings WHERE length(title) > 8 OR length(experience) > 10 OR length(salary) > 15",
        "postings"),
    "check_required": sql("SELECT job_id FROM postings WHERE location IS NULL OR benefits IS NULL", "postings"),
    "cascade_delete": star(
        """, kept AS (SELECT * FROM cleaned WHERE salary_normalized IS NOT NULL),
        kept_skills AS (SELECT * FROM skill_dim WHERE NOT contains(lower(name), 'python')),
        kept_groups AS (SELECT * FROM groups WHERE name IN (SELECT grp FROM kept))
        SELECT 'jobs' AS table_name, count(*) AS n_rows FROM kept
        UNION ALL SELECT 'job_details', count(*) FROM kept
        UNION ALL SELECT 'skills', count(*) FROM kept_skills
        UNION ALL SELECT 'skill_groups', count(*) FROM kept_groups
        UNION ALL SELECT 'job_skills', count(*) FROM skill_rows
          WHERE job_id IN (SELECT job_id FROM kept) AND name IN (SELECT name FROM kept_skills)
        UNION ALL SELECT 'skill_details', count(*) FROM (SELECT DISTINCT name, grp FROM skill_rows
          WHERE name IN (SELECT name FROM kept_skills) AND grp IN (SELECT name FROM kept_groups))"""),
    "cascade_delete_rows": star("""SELECT * EXCLUDE (grp, skills), grp AS "group", array_to_string(list_sort(list_distinct(
        [s FOR s IN skills IF NOT contains(lower(s), 'python')])), '|') AS skills FROM cleaned WHERE salary_normalized IS NOT NULL"""),
    # search
    "facet_groups": star("SELECT name FROM groups"),
    "facet_skills": star("SELECT name FROM skill_dim WHERE regexp_matches(name, '^[A-Za-zÀ-ỹ0-9 ]+$')"),
    "facet_order": star("""SELECT 'group' AS facet, name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) AS position FROM groups
        UNION ALL SELECT 'skill', name, CAST(row_number() OVER (ORDER BY name) AS INTEGER) FROM skill_dim
        WHERE regexp_matches(name, '^[A-Za-zÀ-ỹ0-9 ]+$')"""),
    "facet_locations": sql(f"SELECT DISTINCT location FROM postings WHERE {one_city('location')}", "postings"),
    "facet_experience": sql("SELECT DISTINCT experience FROM postings", "postings"),
    "salary_buckets": sql(
        """SELECT CASE WHEN salary_normalized < 5000000 THEN 'Dưới 5 triệu' WHEN salary_normalized < 10000000 THEN '5 - 10 triệu'
        WHEN salary_normalized < 20000000 THEN '10 - 20 triệu' WHEN salary_normalized < 50000000 THEN '20 - 50 triệu'
        ELSE 'Trên 50 triệu' END AS band, count(*) AS postings FROM flat WHERE salary_normalized IS NOT NULL GROUP BY 1""",
        "postings", "flat"),
    "search_keyword": sql("SELECT job_id, title FROM postings WHERE title ILIKE '%1-urgent%' OR description ILIKE '%1-urgent%'", "postings"),
    "search_keyword_pattern": sql(
        "SELECT job_id, title FROM postings WHERE title ILIKE '%_rder o%high%' OR description ILIKE '%_rder o%high%'", "postings"),
    "search_keyword_accents": sql(
        "SELECT job_id, title FROM postings WHERE contains(strip_accents(lower(requirements)), 'thanh thao')", "postings"),
    "job_skill_lists": star("SELECT job_id, string_agg(name, '|' ORDER BY name) AS skills FROM skill_rows GROUP BY job_id"),
    "search_by_skill": star("SELECT job_id FROM skill_rows WHERE name = 'Python'"),
    "search_all": star(search_columns("", "").replace("'|'", "', '")),
    "search_jobs": found_jobs("""c.grp = 'BUILDING' AND location = 'Hà Nội' AND salary_normalized >= 10000000 AND salary_normalized < 20000000
        AND (title ILIKE '%job%' OR description ILIKE '%job%')
        AND EXISTS (SELECT 1 FROM skill_rows r WHERE r.job_id = c.job_id AND r.name = 'Git')"""),
    "search_order": star("""SELECT job_id AS id, CAST(row_number() OVER (ORDER BY deadline NULLS FIRST, job_id) AS INTEGER) AS position
        FROM cleaned WHERE grp = 'MACHINERY'"""),
    "search_facets": found_jobs("c.grp = 'MACHINERY' AND location = 'Hồ Chí Minh'"),
    "search_band": found_jobs("salary_normalized >= 10000000 AND salary_normalized < 20000000"),
    "search_skill": found_jobs("""(title ILIKE '%1-urgent%' OR description ILIKE '%1-urgent%')
        AND EXISTS (SELECT 1 FROM skill_rows r WHERE r.job_id = c.job_id AND r.name = 'Git')"""),
    "search_pages": found_jobs("c.grp = 'MACHINERY' AND salary_normalized >= 10000000 AND salary_normalized < 20000000"),
    "keyword_lists": star("SELECT job_id, title FROM cleaned WHERE title ILIKE '%1-urgent%' OR description ILIKE '%1-urgent%'"),
    "keyword_lists_pattern": star("SELECT job_id, title FROM cleaned WHERE title ILIKE '%_rder o%high%' OR description ILIKE '%_rder o%high%'"),
    # sources and sinks
    "flatten_blocks": sql(BLOCK_ROWS, "postings", "block_years"),
    "read_blocks": sql(BLOCK_ROWS, "postings", "block_years"),
    "merge_sources": sql(
        """SELECT strftime(crawl_date, '%Y-%m-%d') AS crawl_date, count(*) FILTER (source = 'board_a') AS blocks_board_a,
        count(*) FILTER (source = 'board_b') AS blocks_board_b, count(*) AS total_blocks, CAST(sum(n) AS BIGINT) AS total_jobs
        FROM blocks GROUP BY 1 HAVING count(DISTINCT source) = 2""", "postings", "blocks"),
    "merged_days": sql(
        """SELECT strftime(crawl_date, '%Y-%m-%d') AS crawl_date, source, grp AS "group", link FROM postings
        WHERE crawl_date IN (SELECT crawl_date FROM postings GROUP BY 1 HAVING count(DISTINCT source) = 2)""", "postings"),
    # Blocks went in twice; those of the first source were then replaced by one copy.
    "partitioned_roundtrip": sql(
        f"SELECT * FROM ({BLOCK_ROWS}) UNION ALL SELECT * FROM ({BLOCK_ROWS}) WHERE source = 'board_b'", "postings", "block_years"),
    "export_flat": star(f"SELECT {flat_columns()} FROM cleaned"),
    "csv_roundtrip": star(f"SELECT * REPLACE (CAST(nullif(salary_normalized, '') AS BIGINT) AS salary_normalized) "
                          f"FROM (SELECT {flat_columns()} FROM cleaned)"),
    "cleaned_json_roundtrip": star(
        """SELECT * EXCLUDE (job_id, grp, skills), grp AS "group", array_to_string(skills, '|') AS skills FROM cleaned"""),
    "parse_kv_lines": sql(
        f"""SELECT parts[1] AS key, parts[2] AS value, TRY_CAST(parts[2] AS DOUBLE) AS number
        FROM ({kv_lines('location', 'job_id')} UNION ALL {kv_lines('title', 'salary')}) WHERE len(parts) = 2""", "postings"),
    "catalog_roundtrip": "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name FROM customer",
    "snapshot_restore": star(REJOINED),
    # daily ingest
    "daily_ingest": ingested(),
    "stream_ingest": ingested(),
    "daily_backfill": ingested(
        "CASE WHEN crawl_year = (SELECT min(crawl_year) FROM block_years) THEN '9999' ELSE crawl_year END",
        """w.crawl_date <> (SELECT min(crawl_year) FROM block_years WHERE crawl_year > (SELECT min(crawl_year) FROM block_years))
        OR x."group" = 'BUILDING'"""),
}
