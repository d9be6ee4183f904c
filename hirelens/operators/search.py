"""Faceted job search over the relational model."""

from __future__ import annotations

import datetime
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.fixed_values import NO_TEXT, SALARY_BANDS
from hirelens.functions.salary import in_band, salary_band
from hirelens.functions.text import is_single_city
from hirelens.workspace import stage

Tables = Mapping[str, DataFrame]

# So many ids may be sent to every task.
FEW_JOBS = 100_000

JOB_COLUMNS = [
    "id", "title", "location", "experience", "working_time", "deadline", "salary_raw", "salary_normalized",
]


def facet_groups(tables: Tables) -> DataFrame:
    return tables["skill_groups"].select("name").distinct().orderBy("name")


def facet_skills(tables: Tables) -> DataFrame:
    """Skill names made of letters, digits and spaces only."""
    return tables["skills"].filter(F.col("name").rlike("^[A-Za-zÀ-ỹ0-9 ]+$")).select("name").distinct().orderBy("name")


def facet_locations(tables: Tables) -> DataFrame:
    """Locations that name one place only."""
    return tables["jobs"].filter(is_single_city(F.col("location"))).select("location").distinct().orderBy("location")


def facet_experience(tables: Tables) -> DataFrame:
    return tables["jobs"].select("experience").distinct().orderBy("experience")


def salary_bands(jobs: DataFrame) -> DataFrame:
    """(band, postings) for the postings with a salary."""
    return (
        jobs.groupBy(salary_band(F.col("salary_normalized")).alias("band"))
        .agg(F.count("salary_normalized").alias("postings"))
        .filter(F.col("postings") > 0)
    )


def holds_keyword(text: Column, keyword: str, ignore_accents: bool = False) -> Column:
    """Does the text hold the keyword, letter case ignored?

    `%` and `_` in the keyword stand for any text and any character, in every keyword. A backslash is
    a backslash. `ignore_accents` compares base letters only and takes the keyword literally.
    """
    if ignore_accents:
        return F.contains(F.collate(text, "UNICODE_CI_AI"), F.collate(F.lit(keyword), "UNICODE_CI_AI"))
    escape = "\x01"
    pattern = keyword.lower().replace(escape, escape * 2)
    return F.like(F.lower(text), F.lit(f"%{pattern}%"), F.lit(escape))


def search_keyword(jobs: DataFrame, keyword: str, ignore_accents: bool = False) -> DataFrame:
    """Rows whose title or description holds the keyword."""
    hit = holds_keyword(F.col("title"), keyword, ignore_accents)
    return jobs.filter(hit | holds_keyword(F.col("description"), keyword, ignore_accents))


def job_skill_lists(tables: Tables) -> DataFrame:
    """(job_id, skills): the sorted skill names of every job that has any."""
    named = tables["job_skills"].join(tables["skills"], F.col("skill_id") == F.col("id"))
    return named.groupBy("job_id").agg(F.sort_array(F.collect_set("name")).alias("skills"))


def jobs_with_skill(tables: Tables, skill: str) -> DataFrame:
    """Ids of the jobs that have exactly this skill."""
    wanted = tables["skills"].filter(F.col("name") == skill).select(F.col("id").alias("skill_id"))
    return tables["job_skills"].join(wanted, "skill_id", "left_semi").select("job_id")


def search_ids(
    tables: Tables,
    group: str | None = None,
    skill: str | None = None,
    location: str | None = None,
    experience: str | None = None,
    salary: str | None = None,
    keyword: str | None = None,
    ignore_accents: bool = False,
) -> DataFrame:
    """(id, deadline) of the jobs that meet every given criterion; a criterion left out does not filter.

    `salary` names a band of SALARY_BANDS. Texts are read for a keyword only, and none is carried on.
    """
    jobs = tables["jobs"]
    groups = tables["skill_groups"].select(F.col("id").alias("group_id"), F.col("name").alias("group_name"))
    if group is not None:
        groups = groups.filter(F.col("group_name") == group)
    if location is not None:
        jobs = jobs.filter(F.col("location") == location)
    if experience is not None:
        jobs = jobs.filter(F.col("experience") == experience)
    if salary is not None:
        jobs = jobs.filter(in_band(F.col("salary_normalized"), *SALARY_BANDS[salary]))
    if skill is not None:
        jobs = jobs.join(jobs_with_skill(tables, skill), F.col("id") == F.col("job_id"), "left_semi")
    jobs = jobs.join(groups, "group_id", "left_semi")
    if keyword:
        details = tables["job_details"].select(F.col("job_id").alias("id"), "description")
        jobs = search_keyword(jobs.select("id", "deadline", "title").join(details, "id", "left"), keyword, ignore_accents)
    return jobs.select("id", "deadline")


def _assembled(tables: Tables, many: bool) -> DataFrame:
    """The jobs of these tables with their group, texts, and sorted skill names, an empty array for none.

    Long texts that repeat take few bytes in a file and many in memory, so Catalyst would send to every task what does not fit. With
    `many` jobs the tables are merged in the order of their ids instead.
    """
    def per_job(df: DataFrame) -> DataFrame:
        return df.hint("merge") if many else df

    groups = tables["skill_groups"].select(F.col("id").alias("group_id"), F.col("name").alias("group_name"))
    details = tables["job_details"].select(F.col("job_id").alias("id"), "description", "requirements", "benefits")
    lists = job_skill_lists(tables).withColumnRenamed("job_id", "id")
    found = tables["jobs"].join(groups, "group_id").select(*JOB_COLUMNS, "group_name")
    return (
        found.join(per_job(details), "id", "left").join(per_job(lists), "id", "left")
        .withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))
    )


def fetch(tables: Tables, ids: DataFrame, many: bool = False) -> DataFrame:
    """The jobs with these ids: their columns and group, texts, and sorted skill names, an empty array for none.

    `many` says that the ids are too many to send them to every task.
    """
    wanted = ids.select("id").hint("merge") if many else ids.select("id")
    by_job = wanted.withColumnRenamed("id", "job_id")
    of_them = {
        "jobs": tables["jobs"].join(wanted, "id", "left_semi"),
        "job_details": tables["job_details"].join(by_job, "job_id", "left_semi"),
        # Only the skills of these jobs are worth grouping.
        "job_skills": tables["job_skills"].join(by_job, "job_id", "left_semi"),
    }
    return _assembled({**tables, **of_them}, many)


def _in_order(found: DataFrame) -> DataFrame:
    return found.orderBy(F.asc_nulls_first("deadline"), "id")


def search(tables: Tables, **criteria) -> DataFrame:
    """Jobs that meet every given criterion of `search_ids`, earliest deadline first, no deadline before any.

    The result has the posting's texts and its sorted skill names. Who shows a page at a time had better use `search_page`.
    """
    if all(value is None or value in ("", False) for value in criteria.values()):
        jobs = tables["jobs"].filter(F.col("id").isNotNull())
        return _in_order(_assembled({**tables, "jobs": jobs}, many=jobs.count() > FEW_JOBS))
    # With a keyword the texts are read for the ids once, and not again for each table.
    ids = search_ids(tables, **criteria)
    ids = stage(ids, "ids") if criteria.get("keyword") else ids
    return _in_order(fetch(tables, ids, many=ids.count() > FEW_JOBS))


def search_page(tables: Tables, size: int = 20, after: tuple[datetime.date | None, object] | None = None, **criteria) -> DataFrame:
    """The next `size` jobs of `search` behind the job with the given (deadline, id), from the start without.

    Ids and deadlines are found and cut to the page first; texts and skills are fetched for the page only, and no job before
    it is sorted again.
    """
    found = search_ids(tables, **criteria)
    if after is not None:
        day, last = after
        if day is None:
            found = found.filter(F.col("deadline").isNotNull() | (F.col("id") > last))
        else:
            found = found.filter((F.col("deadline") > F.lit(day)) | ((F.col("deadline") == F.lit(day)) & (F.col("id") > last)))
    page = stage(_in_order(found).limit(size), "page")
    return _in_order(fetch(tables, page))


def as_shown(found: DataFrame) -> DataFrame:
    """Search result with missing texts named as such and the skills in one text."""
    texts = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(NO_TEXT))
             for c in ("description", "requirements", "benefits")}
    return found.withColumns(texts | {"skills": F.array_join("skills", ", ")})
