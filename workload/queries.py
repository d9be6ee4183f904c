"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.fixed_values import SKILL_LEXICON
from hirelens.functions import dates, pages, salary, skills, text
from hirelens.operators import analyses, keyword_index, labels, lexicon, links, profile, quality, search
from hirelens.operators import pages as layouts
from hirelens.operators.pages import PageLayout, Pairs
from hirelens.operators.pages import extract_postings as page_postings
from hirelens.plans import clean, star
from hirelens.plans.daily import ingest_day, read_target
from hirelens.plans.kept_cube import KeptCube
from hirelens.schemas import FLAT_FIELDS, JOB_FIELDS
from hirelens.sources import blocks, flat, keyvalue, tables
from hirelens.streaming.ingest import ingest_stream
from hirelens.workspace import new_dir, stage
from workload.layouts import FIRST, FIRST_WHOLE, SECOND, SECOND_WHOLE, layout_pages
from workload.postings import (
    CRAWL_DATE, cleaned_postings, crawl_arrays, crawl_blocks, derive_postings, flat_postings, model_tables, raw_postings, save_arrays, table,
)

SOURCES = ["board_a", "board_b"]
FIRST_YEAR = 1992
# A lexicon that occurs in the test documents, with terms that overlap each other.
WORDS = ["the", "of", "of the", "and", "in", "de", "la", "de la", "der", "und", "que", "les", "el", "en el"]
SECTION_WORDS = {"description": "the", "requirements": "de", "benefits": "der"}
SECTION = r"(?is)<b>(.*?)<br>\s*<p>(.*?)</p>"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def text_of(date) -> F.Column:
    return F.date_format(date, "yyyy-MM-dd")


@query
def derived_postings(spark, d):
    return derive_postings(spark, d).withColumn("crawl_date", text_of("crawl_date"))


# ---- analyses


def _analysis(name: str) -> None:
    QUERIES[name] = lambda spark, d: analyses.run(name, flat_postings(spark, d))


for _name in analyses.ANALYSES:
    _analysis(_name)


@query
def postings_by_city(spark, d):
    return analyses.postings_by_city(flat_postings(spark, d))


@query
def market_cube(spark, d):
    return analyses.market_cube(flat_postings(spark, d))


def _kept_cube(spark, d) -> KeptCube:
    """A cube kept by day, in which years of the postings stand for days, three a month.

    The first day first gets the rows of another one, and the last day is put after its month was folded without it.
    """
    postings = flat_postings(spark, d).withColumn("_year", F.year("crawl_date") - FIRST_YEAR)
    cube, n = KeptCube(spark, new_dir(spark, "cube")), postings.agg(F.max("_year")).first()[0] + 1
    cube.put_day(_day_of(0), postings.filter(F.col("_year") == 1))
    for year in range(n - 1):
        cube.put_day(_day_of(year), postings.filter(F.col("_year") == year))
    cube.fold()
    cube.put_day(_day_of(n - 1), postings.filter(F.col("_year") == n - 1))
    return cube


def _day_of(year: int) -> datetime.date:
    return datetime.date(2025, 1 + year // 3, 1 + year % 3)


@query
def kept_cube(spark, d):
    return _kept_cube(spark, d).cube()


@query
def kept_cube_range(spark, d):
    """The cube of a range of days that starts in the middle of a month."""
    return _kept_cube(spark, d).cube(_day_of(1), _day_of(5))


# ---- profile


@query
def profile_overview(spark, d):
    raw = raw_postings(spark, d).select("group", "source", *JOB_FIELDS)
    return profile.overview(raw)


@query
def value_counts_location(spark, d):
    return profile.location_counts(raw_postings(spark, d))


@query
def value_counts_salary(spark, d):
    return profile.salary_counts(raw_postings(spark, d))


@query
def top_locations(spark, d):
    return profile.top_values(profile.location_counts(raw_postings(spark, d)), 10)


@query
def top_salaries(spark, d):
    return profile.top_values(profile.salary_counts(raw_postings(spark, d)), 20)


# ---- column functions over postings


@query
def normalize_salary(spark, d):
    raw = raw_postings(spark, d)
    amount = salary.normalize_salary(F.col("salary"))
    strict = salary.normalize_salary(F.col("salary"), mode="strict")
    return (
        raw.select("job_id", "salary", amount.alias("amount"), strict.alias("amount_strict"))
        .withColumn("unit", salary.currency_unit(F.col("amount")))
    )


@query
def parse_deadline(spark, d):
    day = text_of(dates.parse_deadline(F.col("deadline")))
    return raw_postings(spark, d).select("job_id", "deadline", day.alias("day"))


@query
def relative_deadline(spark, d):
    day = F.to_date(F.lit(CRAWL_DATE))
    return raw_postings(spark, d).select(
        "job_id",
        dates.resolve_relative_deadline(F.col("deadline"), day).alias("from_fixed_day"),
        dates.resolve_relative_deadline(F.col("deadline"), F.col("crawl_date")).alias("from_crawl_day"),
    )


@query
def iso_dates(spark, d):
    written = F.when(F.col("o_orderkey") % 7 == 0, F.lit(" ")).otherwise(text_of("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", text_of(dates.iso_date(written)).alias("day"))


@query
def clean_requirements(spark, d):
    cleaned = text.clean_requirements(F.col("requirements"))
    return raw_postings(spark, d).select("job_id", cleaned.alias("cleaned"))


@query
def title_cleanup(spark, d):
    return raw_postings(spark, d).select("job_id", text.strip_parentheses(F.col("title")).alias("title"))


@query
def label_cleanup(spark, d):
    label = F.concat_ws(" ", "p_type", F.col("p_size").cast("string"))
    return table(spark, d, "part").select("p_partkey", text.strip_count(label).alias("label"))


@query
def default_blanks(spark, d):
    return raw_postings(spark, d).select(
        "job_id",
        text.default_blank(F.col("working_time"), "Không rõ").alias("working_time"),
        text.default_blank(F.col("location"), "Không rõ").alias("location"),
        text.default_blank(F.col("benefits"), "N/A").alias("benefits"),
    )


@query
def clean_postings(spark, d):
    cleaned = clean.clean_postings(raw_postings(spark, d), keep=["job_id"])
    return cleaned.withColumns({"deadline": text_of("deadline"), "skills": F.array_join("skills", "|")})


# ---- text and skills


@query
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query
def sentences(spark, d):
    return labels.sentences(table(spark, d, "documents"), F.col("text"), "doc_id")


@query
def skill_spans(spark, d):
    found = raw_postings(spark, d).select("job_id", F.explode(skills.skill_spans(F.col("requirements"))).alias("s"))
    return found.select("job_id", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


@query
def tag_skills(spark, d):
    tagged = skills.tag_skills(F.col("requirements"))
    return raw_postings(spark, d).select("job_id", F.array_join(tagged, "|").alias("skills"))


@query
def non_overlapping_spans(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))
    spans = skills.non_overlapping(skills.skill_spans(F.col("cleaned"), WORDS))
    return (
        docs.select("doc_id", F.explode(spans).alias("s"))
        .select("doc_id", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))
    )


# Terms of the shipped lexicon put between the lines of a document, so that it meets many different texts.
PLANTED = "array_join(transform(split(d.text, '\n'), (x, i) -> concat(x, ' ', element_at({terms}, cast((i * 7 + d.doc_id) % {n} as int) + 1), if(i % 3 = 0, '.', ' '))), '\n')"


def planted_texts(spark, d) -> DataFrame:
    """doc_id and text of the documents, a term of the lexicon at the end of each line."""
    terms = "array(" + ", ".join("'" + t + "'" for t in SKILL_LEXICON) + ")"
    return spark.sql(f"SELECT d.doc_id, {PLANTED.format(terms=terms, n=len(SKILL_LEXICON))} AS text FROM {{d}} d", d=table(spark, d, "documents"))


@query
def lexicon_in_documents(spark, d):
    found = planted_texts(spark, d).select("doc_id", F.explode(skills.skill_spans(F.col("text"))).alias("s"))
    return found.select("doc_id", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


@query
def lexicon_table(spark, d):
    """Words and pairs of different neighbouring words of all benchmark items, looked for in all documents."""
    words = F.split(F.trim(F.regexp_replace("text", "[^A-Za-z0-9]+", " ")), " ")
    places = F.filter(F.slice(F.sequence(F.lit(1), F.size(words)), F.lit(1), F.size(words) - 1), lambda i: F.lower(F.get(words, i - 1)) != F.lower(F.get(words, i)))
    pairs = F.transform(places, lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))
    terms = table(spark, d, "benchmark").select(F.explode(F.concat(words, pairs)).alias("term"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = (
        docs.select("doc_id", lexicon.text_key(F.col("text")).alias("key"))
        .join(lexicon.lexicon_spans(docs, terms, keyed=True), "key").select("doc_id", F.explode("spans").alias("s")))
    return found.select("doc_id", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


@query
def label_sentences(spark, d):
    labelled = labels.label_sentences(table(spark, d, "documents"), F.col("text"), WORDS)
    return (
        labelled.select("text", F.explode("entities").alias("e"))
        .select("text", F.col("e.start").alias("start_at"), F.col("e.end").alias("end_at"), F.col("e.label").alias("label"))
    )


# ---- pages


@query
def pages_not_blocked(spark, d):
    return links.not_blocked(table(spark, d, "pages"), marker="de").select("page_id", "url")


@query
def pages_link_filter(spark, d):
    found = table(spark, d, "pages").select("page_id", F.posexplode(pages.page_links(F.col("html"))).alias("pos", "link"))
    return links.without_links(found, marker="/th")


@query
def group_filter(spark, d):
    return links.only_group(raw_postings(spark, d), "building").select("job_id", "group")


@query
def page_titles(spark, d):
    title = pages.posting_title(F.col("html"), "example.com")
    return table(spark, d, "pages").select("page_id", title.alias("title"))


@query
def extract_postings(spark, d):
    layout = PageLayout(
        site="example.com",
        fields={"deadline": r"(?is)<footer>(.*?)</footer>", "experience": r"(?is)<h6>(.*?)</h6>"},
        pairs=[Pairs(SECTION, SECTION_WORDS), Pairs(pages.LINK, {"salary": "der", "location": "que"}, label=2, value=1)],
        lists={"working_time": pages.LIST_ITEM},
        copies={"work_location_detail": "location"},
        missing="N/A",
    )
    return page_postings(table(spark, d, "pages"), layout, F.to_date(F.lit(CRAWL_DATE)), keep=["page_id"])


@query
def first_layout(spark, d):
    return page_postings(layout_pages(spark, d, FIRST), layouts.first_layout("example.com"), F.to_date(F.lit(CRAWL_DATE)), keep=["page_id"])


@query
def second_layout(spark, d):
    return page_postings(layout_pages(spark, d, SECOND), layouts.second_layout("example.com"), F.to_date(F.lit(CRAWL_DATE)), keep=["page_id"])


@query
def first_layout_whole(spark, d):
    return page_postings(layout_pages(spark, d, FIRST_WHOLE), layouts.first_layout("example.com"), F.to_date(F.lit(CRAWL_DATE)), keep=["page_id"])


@query
def second_layout_whole(spark, d):
    return page_postings(layout_pages(spark, d, SECOND_WHOLE), layouts.second_layout("example.com"), F.to_date(F.lit(CRAWL_DATE)), keep=["page_id"])


@query
def page_sections(spark, d):
    pairs = table(spark, d, "pages").select("page_id", pages.labelled_pairs(F.col("html"), SECTION).alias("pairs"))
    return pairs.select("page_id", *[
        pages.pick_field(F.col("pairs"), f, SECTION_WORDS).alias(f) for f in SECTION_WORDS])


@query
def page_lists(spark, d):
    return table(spark, d, "pages").select("page_id", pages.bullet_text(F.col("html")).alias("bullets"))


@query
def url_slug(spark, d):
    found = table(spark, d, "pages").select(
        "page_id", text.slug(pages.page_title(F.col("html"))).alias("slug"),
        F.posexplode(pages.page_links(F.col("html"))).alias("pos", "link"))
    url = text.absolute_url("https://jobs.example.com", F.col("link"))
    return found.select("page_id", "pos", url.alias("url"), "slug")


# ---- which postings to keep


@query
def union_sources(spark, d):
    raw = raw_postings(spark, d)
    a = raw.filter(F.col("source") == "board_a").select("job_id", "source", "title", "salary")
    b = raw.filter(F.col("source") == "board_b").select("source", "job_id", "location", "title")
    return blocks.union_sources(a, b)


@query
def dedup_links(spark, d):
    return links.first_per_key(raw_postings(spark, d), order=["job_id"]).select("job_id", "group", "link", "title")


@query
def new_links(spark, d):
    raw = raw_postings(spark, d)
    seen = raw.filter(F.col("crawl_date") < "1996-01-01")
    fresh = raw.filter(F.col("crawl_date") >= "1996-01-01")
    return links.new_links(fresh, seen, order=["job_id"]).select("job_id", "group", "link")


@query
def cap_per_group(spark, d):
    return links.cap_per_group(raw_postings(spark, d), order=["job_id"]).select("job_id", "group")


# ---- relational model


def _with_text_dates(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("deadline", text_of("deadline"))


@query
def dim_groups(spark, d):
    return star.dimension(star.group_names(cleaned_postings(spark, d)))


@query
def dim_skills(spark, d):
    return star.dimension(star.skill_names(cleaned_postings(spark, d)))


@query
def dim_skills_case_blind(spark, d):
    return star.dimension(star.skill_names(cleaned_postings(spark, d)), case_blind=True)


@query
def dim_parts(spark, d):
    return star.dimension(table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("name")))


@query
def skill_details(spark, d):
    postings = cleaned_postings(spark, d)
    groups, names = star.dimension(star.group_names(postings)), star.dimension(star.skill_names(postings))
    return star.skill_details(postings, groups, names)


@query
def load_jobs(spark, d):
    postings = cleaned_postings(spark, d)
    return _with_text_dates(star.jobs(postings, star.dimension(star.group_names(postings))))


@query
def load_job_details(spark, d):
    return star.job_details(cleaned_postings(spark, d))


@query
def job_skills(spark, d):
    postings = cleaned_postings(spark, d)
    return star.job_skills(postings, star.dimension(star.skill_names(postings)))


@query
def upsert_dimension(spark, d):
    names = star.skill_names(cleaned_postings(spark, d))
    parts = table(spark, d, "part").select(F.col("p_brand").alias("name"))
    both = parts.unionByName(names)
    return star.upsert_dimension(star.dimension(names), both)


@query
def job_keys(spark, d):
    rows = raw_postings(spark, d).select("group", "link", "title", "salary")
    return star.with_job_ids(rows).groupBy("group").agg(F.countDistinct("job_id").alias("jobs"))


@query
def job_key_rows(spark, d):
    """The key of every different posting, hashed from all of its columns."""
    rows = raw_postings(spark, d).drop("job_id").withColumn("crawl_date", F.col("crawl_date").cast("string"))
    return star.with_job_ids(rows).select("job_id", "group", "link", "title", "salary")


@query
def star_rejoin(spark, d):
    path = new_dir(spark, "star")
    whole = star.rejoin(star.load_star(cleaned_postings(spark, d), path))
    return _with_text_dates(whole).withColumn("skills", F.array_join("skills", "|"))


def _rejoined(tables: dict[str, DataFrame]) -> DataFrame:
    return _with_text_dates(star.rejoin(tables)).withColumn("skills", F.array_join("skills", "|"))


@query
def load_star_again(spark, d):
    path, postings = new_dir(spark, "star"), cleaned_postings(spark, d)
    star.load_star(postings.filter(F.col("job_id") % 2 == 0), path)
    return _rejoined(star.extend_star(postings, path))


@query
def star_ids_stay(spark, d):
    path, postings = new_dir(spark, "star"), cleaned_postings(spark, d)
    first = star.load_star(postings.filter(F.col("job_id") % 3 == 0), path)
    again = star.extend_star(postings, path)
    kinds = []
    for kind in ("skill_groups", "skills"):
        now = again[kind].groupBy("name").agg(F.min("id").alias("id"), F.count("*").alias("n"))
        then = first[kind].select("name", F.col("id").alias("old"))
        kinds.append(now.join(then, "name", "left").select(
            F.lit(kind).alias("kind"), "name", ((F.col("n") == 1) & F.coalesce(F.col("id") == F.col("old"), F.lit(True))).alias("stays")))
    return kinds[0].unionByName(kinds[1])


# ---- constraints


@query
def check_unique(spark, d):
    return quality.duplicate_keys(raw_postings(spark, d), ["group", "link"])


@query
def check_foreign_keys(spark, d):
    solvent = table(spark, d, "customer").filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("id"))
    return quality.orphans(table(spark, d, "orders"), "o_custkey", solvent).select("o_orderkey", "o_custkey")


@query
def check_lengths(spark, d):
    return quality.too_long(raw_postings(spark, d), {"title": 8, "experience": 10, "salary": 15}).select("job_id", "title")


@query
def check_required(spark, d):
    return quality.missing_values(raw_postings(spark, d), ["location", "benefits"]).select("job_id")


@query
def check_model(spark, d):
    """The constraints of a model that lost some skills and holds one group's jobs twice."""
    model = model_tables(spark, d)
    again = model["jobs"].filter(F.col("group_id") == 1)
    model["jobs"] = model["jobs"].unionByName(again)
    model["skills"] = model["skills"].filter(~F.lower("name").contains("python"))
    return quality.violations(model)


@query
def check_added(spark, d):
    """The constraints on an addition: the jobs with odd ids, those with even ids of one group again, no Python skills."""
    model = model_tables(spark, d)
    ids = {"jobs": "id", "job_details": "job_id", "job_skills": "job_id"}
    python = F.lower("name").contains("python")
    even = {name: df.filter(F.col(ids[name]) % 2 == 0) if name in ids else df for name, df in model.items()}
    odd = {name: df.filter(F.col(ids[name]) % 2 == 1) if name in ids else df.limit(0) for name, df in model.items()}
    gone = model["skills"].filter(python).select(F.col("id").alias("skill_id"))
    even |= {"skills": model["skills"].filter(~python), "skill_details": model["skill_details"].limit(0),
             "job_skills": even["job_skills"].join(gone, "skill_id", "left_anti")}
    odd |= {"skill_details": model["skill_details"], "jobs": odd["jobs"].unionByName(even["jobs"].filter(F.col("group_id") == 1))}
    path = new_dir(spark, "star")
    star.save_star(even, path)
    return star.guard(spark, path).violations(odd, star.current_parts(spark, path))


def _sizes(found: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in found.items()]
    return reduce(DataFrame.unionByName, counts)


def _cut_down(spark, d) -> dict[str, DataFrame]:
    model = model_tables(spark, d)
    gone = model["jobs"].filter(F.col("salary_normalized").isNull()).select("id")
    model = quality.delete_rows(model, "jobs", gone)
    named = model["skills"].filter(F.lower("name").contains("python")).select("id")
    model = quality.delete_rows(model, "skills", named)
    return quality.delete_rows(model, "skill_groups", model["skill_groups"].select("id"))


@query
def cascade_delete(spark, d):
    return _sizes(_cut_down(spark, d))


@query
def cascade_delete_rows(spark, d):
    return _rejoined(_cut_down(spark, d))


# ---- search


@query
def facet_groups(spark, d):
    return search.facet_groups(model_tables(spark, d))


@query
def facet_skills(spark, d):
    return search.facet_skills(model_tables(spark, d))


@query
def facet_locations(spark, d):
    return search.facet_locations(model_tables(spark, d))


@query
def facet_experience(spark, d):
    return search.facet_experience(model_tables(spark, d))


@query
def salary_buckets(spark, d):
    return search.salary_bands(flat_postings(spark, d))


def _texts(spark, d) -> DataFrame:
    return raw_postings(spark, d).select("job_id", "title", "description")


@query
def search_keyword(spark, d):
    return search.search_keyword(_texts(spark, d), "1-URgent").select("job_id", "title")


@query
def search_keyword_pattern(spark, d):
    return search.search_keyword(_texts(spark, d), "_rder o%high").select("job_id", "title")


@query
def search_keyword_accents(spark, d):
    texts = raw_postings(spark, d).select("job_id", "title", F.col("requirements").alias("description"))
    return search.search_keyword(texts, "Thanh Thao", ignore_accents=True).select("job_id", "title")


@query
def job_skill_lists(spark, d):
    lists = search.job_skill_lists(model_tables(spark, d))
    return lists.select("job_id", F.array_join("skills", "|").alias("skills"))


@query
def search_by_skill(spark, d):
    return search.jobs_with_skill(model_tables(spark, d), "Python")


def _result(found: DataFrame) -> DataFrame:
    return _with_text_dates(search.as_shown(found))


@query
def search_all(spark, d):
    return _result(search.search(model_tables(spark, d)))


@query
def search_jobs(spark, d):
    return _result(search.search(
        model_tables(spark, d), group="BUILDING", skill="Git", location="Hà Nội", salary="10 - 20 triệu", keyword="job"))


def _positions(found: DataFrame, column: str) -> DataFrame:
    """The place of every row in a result, as it comes."""
    placed = found.select(column, F.monotonically_increasing_id().alias("_at"))
    return placed.select(column, F.row_number().over(Window.orderBy("_at")).alias("position"))


@query
def search_order(spark, d):
    return _positions(search.search(model_tables(spark, d), group="MACHINERY"), "id")


@query
def facet_order(spark, d):
    tables = model_tables(spark, d)
    groups = _positions(search.facet_groups(tables), "name").withColumn("facet", F.lit("group"))
    return groups.unionByName(_positions(search.facet_skills(tables), "name").withColumn("facet", F.lit("skill")))


@query
def search_facets(spark, d):
    return _result(search.search(model_tables(spark, d), group="MACHINERY", location="Hồ Chí Minh"))


@query
def search_band(spark, d):
    return _result(search.search(model_tables(spark, d), salary="10 - 20 triệu"))


@query
def search_skill(spark, d):
    return _result(search.search(model_tables(spark, d), skill="Git", keyword="1-urgent"))


@query
def search_pages(spark, d):
    """All jobs of a band and group, page after page."""
    tables, after, shown = model_tables(spark, d), None, []
    size = max(1, -(-search.search_ids(tables, group="MACHINERY", salary="10 - 20 triệu").count() // 4))
    for _ in range(4):
        page = search.search_page(tables, size, after, group="MACHINERY", salary="10 - 20 triệu")
        shown.append(page)
        last = page.select("deadline", "id").collect()[-1:]  # one page
        after = (last[0].deadline, last[0].id) if last else after
    return _result(reduce(DataFrame.unionByName, shown))


def _indexed(spark, d, keyword: str) -> DataFrame:
    tables, path = model_tables(spark, d), new_dir(spark, "keywords")
    keyword_index.build_index(tables, path)
    return keyword_index.jobs_with_keyword(tables, path, keyword).withColumnRenamed("id", "job_id")


@query
def keyword_lists(spark, d):
    return _indexed(spark, d, "1-URgent")


@query
def keyword_lists_pattern(spark, d):
    return _indexed(spark, d, "_rder o%high")


# ---- sources and sinks


@query
def flatten_blocks(spark, d):
    path = new_dir(spark, "blocks")
    blocks.append_blocks(crawl_blocks(spark, d, "year"), path)
    postings = blocks.flatten(blocks.read_layout(spark, path))
    return postings.withColumn("crawl_date", text_of("crawl_date"))


@query
def read_blocks(spark, d):
    """Files that hold one JSON array each, as crawlers write them."""
    path = new_dir(spark, "arrays")
    save_arrays(crawl_arrays(spark, d, "year"), path)
    return blocks.read_blocks(spark, path).withColumn("crawl_date", F.col("crawl_date").cast("string"))


@query
def read_ungrouped(spark, d):
    path = new_dir(spark, "plain")
    raw_postings(spark, d).select(*JOB_FIELDS).write.json(path)
    return blocks.read_ungrouped(spark, path, multi_line=False).drop("source")


@query
def broken_blocks(spark, d):
    """Folders with files that end in the middle: all files of one source do."""
    path = new_dir(spark, "broken")
    half = F.when(F.col("source") == "board_b", F.expr("left(value, length(value) div 2)")).otherwise(F.col("value"))
    save_arrays(crawl_arrays(spark, d, "year").withColumn("value", half), path)
    place = [F.regexp_extract("file", f"{name}=([^/]+)/", 1).alias(name) for name in ("crawl_date", "source")]
    return blocks.broken_blocks(spark, path).select(*place, (F.length("record") > 0).alias("has_record")).distinct()


@query
def merge_sources(spark, d):
    totals = blocks.merged_totals(crawl_blocks(spark, d, "day"), SOURCES)
    return totals.withColumn("crawl_date", text_of("crawl_date"))


@query
def merged_days(spark, d):
    merged = blocks.flatten(blocks.complete_days(crawl_blocks(spark, d, "day"), SOURCES))
    return merged.select(text_of("crawl_date").alias("crawl_date"), "source", "group", "link")


@query
def partitioned_roundtrip(spark, d):
    path = new_dir(spark, "days")
    crawled = stage(crawl_blocks(spark, d, "year"), "crawled")
    blocks.append_blocks(crawled, path)
    blocks.append_blocks(crawled, path)
    blocks.replace_days(crawled.filter(F.col("source") == "board_a"), path)
    return blocks.flatten(blocks.read_layout(spark, path)).withColumn("crawl_date", text_of("crawl_date"))


def _flat_rows(spark, d) -> DataFrame:
    return flat.flat_export(cleaned_postings(spark, d))


@query
def export_flat(spark, d):
    return _flat_rows(spark, d)


@query
def csv_roundtrip(spark, d):
    path = new_dir(spark, "csv")
    flat.write_flat_csv(_flat_rows(spark, d), path)
    return flat.typed(flat.read_flat_csv(spark, path)).select(*FLAT_FIELDS)


@query
def cleaned_json_roundtrip(spark, d):
    path = new_dir(spark, "json")
    flat.write_cleaned_json(cleaned_postings(spark, d), path)
    cleaned = flat.read_cleaned_json(spark, path)
    return cleaned.withColumns({"deadline": text_of("deadline"), "skills": F.array_join("skills", "|")})


@query
def parse_kv_lines(spark, d):
    path = new_dir(spark, "lines")
    keyvalue.write_key_values(raw_postings(spark, d).select("location", "job_id"), f"{path}/ids")
    keyvalue.write_key_values(raw_postings(spark, d).select("title", "salary"), f"{path}/salaries")
    return keyvalue.read_key_values(spark, f"{path}/ids").unionByName(
        keyvalue.read_key_values(spark, f"{path}/salaries"))


def _database(spark, label: str) -> str:
    path = new_dir(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    tables.create_database(spark, name, path)
    return name


@query
def catalog_roundtrip(spark, d):
    path = new_dir(spark, "users")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    table(spark, d, "customer").select("c_custkey", "c_name").write.csv(path, header=True)
    return tables.create_table_from_csv(spark, f"{_database(spark, 'demo')}.users", schema, path)


@query
def snapshot_restore(spark, d):
    first, path = _database(spark, "model"), new_dir(spark, "snapshot")
    tables.save_tables(model_tables(spark, d), first, buckets={
        "jobs": (8, "id"), "job_details": (8, "job_id"), "job_skills": (8, "job_id")})
    tables.snapshot(spark, first, path)
    second = f"{first}_restored"
    tables.restore(spark, path, second, location=new_dir(spark, "restored"))
    return _rejoined(tables.read_tables(spark, second))


# ---- daily ingest


@query
def daily_ingest(spark, d):
    raw, target = new_dir(spark, "raw"), new_dir(spark, "postings")
    blocks.append_blocks(crawl_blocks(spark, d, "year"), raw)
    days = blocks.read_layout(spark, raw).select("crawl_date").distinct().orderBy("crawl_date")
    for row in days.collect():
        ingest_day(spark, raw, target, row.crawl_date, SOURCES)
    return _ingested(spark, target)


def _ingested(spark, target: str) -> DataFrame:
    return read_target(spark, target).withColumns({
        "crawl_date": text_of("crawl_date"), "deadline": text_of("deadline"), "skills": F.array_join("skills", "|")})


@query
def daily_backfill(spark, d):
    """The first day comes last, and one day is run again after its files shrank to one group."""
    raw, target = new_dir(spark, "raw"), new_dir(spark, "postings")
    blocks.append_blocks(crawl_blocks(spark, d, "year"), raw)
    layout = blocks.read_layout(spark, raw)
    first, second, *others = sorted(r.crawl_date for r in layout.select("crawl_date").distinct().collect())
    for day in (second, *others, first):
        ingest_day(spark, raw, target, day, SOURCES)
    shrunk = stage(layout.filter((F.col("crawl_date") == F.lit(second)) & (F.col("group") == "BUILDING")), "shrunk")
    blocks.replace_days(shrunk.select("crawl_date", "source", "group", "jobs"), raw)
    ingest_day(spark, raw, target, second, SOURCES)
    return _ingested(spark, target)


@query
def stream_ingest(spark, d):
    raw, target = new_dir(spark, "raw"), new_dir(spark, "streamed")
    blocks.append_blocks(crawl_blocks(spark, d, "year"), raw)
    ingest_stream(spark, raw, target, checkpoint=new_dir(spark, "progress"), sources=SOURCES)
    return _ingested(spark, target)
