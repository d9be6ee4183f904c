"""Column functions for dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.fixed_values import DAY, DEADLINE_PREFIX, EXPIRES_IN, MONTH, WEEK
from hirelens.functions.text import strip


def parse_deadline(c: Column) -> Column:
    """First dd/MM/yyyy in the text as a date; null if there is none or it is no real day."""
    return F.try_to_date(F.regexp_extract(c, r"\d{2}/\d{2}/\d{4}", 0), "dd/MM/yyyy")


def iso_date(c: Column) -> Column:
    """yyyy-MM-dd text to a date, blank to null."""
    return F.try_to_date(F.nullif(strip(c), F.lit("")), "yyyy-MM-dd")


def resolve_relative_deadline(c: Column, crawl_date: Column) -> Column:
    """"expires in N days/weeks/months" to the day itself, counted from the crawl date.

    Any other text comes back unchanged. So does one that leads beyond the year 9999, which is the only bound.
    """
    text = F.lower(strip(c))
    rest = strip(F.replace(text, F.lit(EXPIRES_IN), F.lit("")))
    pattern = r"(?U)^([+-]?[0-9]+)\s+(\S+)"
    number = F.regexp_extract(rest, pattern, 1).try_cast("bigint")
    # More days than lie between the first and the last year lead out of them in any unit.
    count = F.when(number.between(-4_000_000, 4_000_000), number).cast("int")
    unit = F.regexp_extract(rest, pattern, 2)
    day = (
        F.when(unit.contains(DAY), F.date_add(crawl_date, count))
        .when(unit.contains(WEEK), F.date_add(crawl_date, count * 7))
        .when(unit.contains(MONTH), F.add_months(crawl_date, count))
    )
    written = F.when(F.year(day).between(1, 9999), F.date_format(day, "dd/MM/yyyy"))
    resolved = F.concat(F.lit(DEADLINE_PREFIX), written)
    return F.when(text.contains(EXPIRES_IN), F.coalesce(resolved, c)).otherwise(c)
