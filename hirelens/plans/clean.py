"""From raw postings to cleaned ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.fixed_values import UNKNOWN, USD_TO_VND
from hirelens.functions.dates import parse_deadline
from hirelens.functions.salary import currency_unit, normalize_salary
from hirelens.functions.skills import tag_skills
from hirelens.functions.text import clean_requirements, default_blank
from hirelens.schemas import CLEANED


def clean_postings(
    raw: DataFrame,
    tagger: Callable[[Column], Column] = tag_skills,
    usd_rate: int = USD_TO_VND,
    salary_mode: str = "compat",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The 15 columns of a cleaned posting, after the columns named in `keep`.

    `tagger` turns the cleaned requirements into the array of skills. Nothing is shuffled.
    """
    return (
        raw.withColumn("requirements", clean_requirements(F.coalesce("requirements", F.lit(""))))
        .withColumn("salary_normalized", normalize_salary(F.col("salary"), usd_rate, salary_mode))
        .withColumns({
            "deadline": parse_deadline(F.col("deadline")),
            "working_time": default_blank(F.col("working_time"), UNKNOWN),
            "salary_raw": F.col("salary"),
            "currency_unit": currency_unit(F.col("salary_normalized")),
            "skills": tagger(F.col("requirements")),
        })
        .select(*keep, *CLEANED.names)
    )
