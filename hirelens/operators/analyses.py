"""The eight market analyses over flat postings, and the market cube.

Every analysis takes a frame with the columns of the flat export; `salary_normalized` is a bigint.
A line whose key or value is blank or holds a tab cannot be reported and is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.fixed_values import BIG_CITIES, HIGH_SALARY_VND, NO_EXPERIENCE
from hirelens.functions.text import contains_any, first_number, is_single_city, is_usable, split_cities, strip


def high_salary(postings: DataFrame, minimum: int = HIGH_SALARY_VND) -> DataFrame:
    """(title, salary_vnd) of the postings that pay at least `minimum`."""
    return (
        postings.filter(F.col("salary_normalized") >= minimum)
        .filter(is_usable(F.col("title")))
        .select(strip(F.col("title")).alias("title"), F.col("salary_normalized").alias("salary_vnd"))
    )


def in_cities(postings: DataFrame, cities: Sequence[str] = BIG_CITIES) -> DataFrame:
    """(title, location) of the postings in one of the cities, location in lower case."""
    return (
        postings.filter(contains_any(F.col("location"), list(cities)))
        .filter(is_usable(F.col("title")) & is_usable(F.col("location")))
        .select(
            strip(F.col("title")).alias("title"),
            F.lower(strip(F.col("location"))).alias("location"),
        )
    )


def needs_no_experience(experience: Column) -> Column:
    """Says "not required", or the first number in it is a plain 0."""
    text = F.lower(strip(experience))
    return text.contains(NO_EXPERIENCE) | (first_number(text) == "0")


def no_experience(postings: DataFrame) -> DataFrame:
    """(title, experience) of the postings open to beginners, experience in lower case."""
    return (
        postings.filter(needs_no_experience(F.col("experience")))
        .filter(is_usable(F.col("title")) & is_usable(F.col("experience")))
        .select(
            strip(F.col("title")).alias("title"),
            F.lower(strip(F.col("experience"))).alias("experience"),
        )
    )


def with_skill(postings: DataFrame, skill: str = "python") -> DataFrame:
    """(title, skills) of the postings that name a skill containing `skill`; skills in lower case."""
    skills = F.transform(F.split(F.lower(strip(F.col("skills"))), ","), strip)
    return (
        postings.filter(is_usable(F.col("title")) & is_usable(F.col("skills")))
        .filter(F.exists(skills, lambda s: s.contains(skill.lower())))
        .select(strip(F.col("title")).alias("title"), F.array_join(skills, ", ").alias("skills"))
    )


def avg_salary_by_city(postings: DataFrame) -> DataFrame:
    """(city, avg_salary_vnd, postings) over the paid postings in exactly one city.

    The mean is not rounded; round it where it is shown.
    """
    # avg and count pass over unpaid postings by themselves. Filtering cities instead of rows
    # means that a salary worked out from text is worked out once.
    return (
        postings.filter(is_single_city(F.col("location")) & is_usable(F.col("location")))
        .groupBy(strip(F.col("location")).alias("city"))
        .agg(F.avg("salary_normalized").alias("avg_salary_vnd"), F.count("salary_normalized").alias("postings"))
        .filter(F.col("postings") > 0)
    )


def postings_by_group(postings: DataFrame) -> DataFrame:
    """(group, postings)."""
    return (
        postings.filter(is_usable(F.col("group")))
        .groupBy(strip(F.col("group")).alias("group"))
        .agg(F.count("*").alias("postings"))
    )


def postings_by_city(postings: DataFrame) -> DataFrame:
    """(city, postings); a posting in several cities counts once for each time it names one."""
    return (
        postings.select(F.explode(split_cities(F.col("location"))).alias("city"))
        .filter(is_usable(F.col("city")))
        .groupBy("city")
        .agg(F.count("*").alias("postings"))
    )


def top_paid_jobs(postings: DataFrame, k: int = 10) -> DataFrame:
    """(title, salary_vnd) of the k best paid postings; equal salaries by title, last title first."""
    return (
        postings.filter(F.col("salary_normalized").isNotNull() & is_usable(F.col("title")))
        .select(strip(F.col("title")).alias("title"), F.col("salary_normalized").alias("salary_vnd"))
        .orderBy(F.desc("salary_vnd"), F.desc("title"))
        .limit(k)
    )


def top_cities(postings: DataFrame, k: int = 10) -> DataFrame:
    """(city, postings) of the k cities with most postings; equal counts by city name."""
    return postings_by_city(postings).orderBy(F.desc("postings"), F.asc("city")).limit(k)


class Analysis(NamedTuple):
    """A named analysis: what it shows, how its two columns are labelled, and how it is computed."""

    title: str
    labels: dict[str, str]
    run: Callable[[DataFrame], DataFrame]


ANALYSES: dict[str, Analysis] = {
    "jobs_high_salary": Analysis(
        "Postings that pay 10 million VND or more", {"title": "Posting", "salary_vnd": "Salary (VND)"}, high_salary),
    "jobs_in_cities": Analysis(
        "Postings in Hà Nội or Hồ Chí Minh", {"title": "Posting", "location": "Place"}, in_cities),
    "jobs_no_experience": Analysis(
        "Postings that need no experience", {"title": "Posting", "experience": "Experience"}, no_experience),
    "jobs_with_skill": Analysis(
        "Postings that need Python", {"title": "Posting", "skills": "Skills"}, with_skill),
    "avg_salary_by_city": Analysis(
        "Mean salary per city", {"city": "City", "avg_salary_vnd": "Mean salary (VND)"}, avg_salary_by_city),
    "top_paid_jobs": Analysis(
        "Ten best paid postings", {"title": "Posting", "salary_vnd": "Salary (VND)"}, top_paid_jobs),
    "postings_by_group": Analysis(
        "Postings per group", {"group": "Group", "postings": "Postings"}, postings_by_group),
    "top_cities": Analysis(
        "Ten cities with most postings", {"city": "City", "postings": "Postings"}, top_cities),
}


def run(name: str, postings: DataFrame) -> DataFrame:
    """Run one analysis of the catalogue by name."""
    return ANALYSES[name].run(postings)


CUBE_KEYS = ["group", "city", "experience"]


def _cells(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count("salary_normalized").alias("paid"),
        F.sum(F.col("salary_normalized").cast("double")).alias("total"),
    )


def city_cells(postings: DataFrame) -> DataFrame:
    """(group, city, experience, n, paid, total): the finest cells; a posting counts in each of its cities."""
    return _cells(postings.withColumn("city", F.explode_outer(split_cities(F.col("location")))), *CUBE_KEYS)


def whole_cells(postings: DataFrame) -> DataFrame:
    """(group, experience, n, paid, total): the cells where cities are summed over; a posting counts once."""
    return _cells(postings, "group", "experience")


def cube_of(by_city: DataFrame, over_cities: DataFrame) -> DataFrame:
    """The cube from `city_cells` and `whole_cells`; a cell may stand on several rows, which are summed up."""
    measures = [F.sum("n").alias("postings"), F.try_divide(F.sum("total"), F.sum("paid")).alias("avg_salary_vnd")]
    group, city, experience = (F.col(k) for k in CUBE_KEYS)
    in_cities = by_city.groupingSets(
        [[group, city, experience], [group, city], [city, experience], [city]], group, city, experience,
    ).agg(F.grouping_id().cast("int").alias("level"), *measures)
    # Two bits, of group and experience, with the set bit of the city put between them.
    pair = F.grouping_id().cast("int")
    summed = over_cities.cube("group", "experience").agg(
        (F.floor(pair / 2) * 4 + 2 + pair % 2).cast("int").alias("level"), *measures)
    return in_cities.unionByName(summed.withColumn("city", F.lit(None).cast("string")))


def market_cube(postings: DataFrame) -> DataFrame:
    """Postings and mean salary for every combination of group, city and experience.

    `level` is the grouping id: a set bit means the column is summed over. A posting in several cities counts in each of
    them, but once where cities are summed over. Rows are first aggregated to the finest cells, so that cells are
    expanded and not postings.
    """
    return cube_of(city_cells(postings), whole_cells(postings))
