"""Column functions for salaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.fixed_values import CURRENCY, MILLION, NEGOTIABLE, SALARY_BANDS, USD_TO_VND
from hirelens.functions.text import strip


def normalize_salary(c: Column, usd_rate: int = USD_TO_VND, mode: str = "compat") -> Column:
    """Salary text to whole VND, null where it names no positive amount.

    A text with several numbers gives their mean. `mode="compat"` reads every dot as a decimal
    point, so `15.000.000` is two numbers; `mode="strict"` reads dot-grouped thousands as one
    number unless the text counts in millions.
    """
    if mode not in ("compat", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    text = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit(","), F.lit(""))
    if mode == "strict":
        ungrouped = F.regexp_replace(text, r"(?<=\d)\.(?=\d{3}(?!\d))", "")
        text = F.when(text.contains("triệu"), text).otherwise(ungrouped)
    factor = (
        F.when(text.contains("usd") | text.contains("$"), usd_rate)
        .when(text.contains("triệu"), MILLION)
        .otherwise(1)
    )

    def add(acc: Column, number: Column) -> Column:
        return F.struct((acc["sum"] + number.try_cast("double")).alias("sum"), (acc["n"] + 1).alias("n"))

    def amount(acc: Column) -> Column:
        mean = F.try_divide(acc["sum"], acc["n"])
        return F.when(mean * factor >= 1, (mean * factor).try_cast("bigint"))

    # One walk over the numbers gives sum, count and amount: the text is matched only once.
    numbers = F.regexp_extract_all(text, F.lit(r"\d+(?:\.\d+)?"), F.lit(0))
    nothing = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"))
    negotiable = reduce(Column.__or__, (text.contains(word) for word in NEGOTIABLE))
    return F.when(~negotiable, F.aggregate(numbers, nothing, add, amount))


def currency_unit(salary: Column) -> Column:
    return F.when(salary.isNotNull(), F.lit(CURRENCY))


def digits_or_null(c: Column) -> Column:
    """Text made of digits only to bigint, null otherwise."""
    text = strip(c)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def in_band(salary: Column, low: int | None, high: int | None) -> Column:
    """low <= salary < high, an open end where the bound is None."""
    test = salary.isNotNull()
    if low is not None:
        test = test & (salary >= low)
    if high is not None:
        test = test & (salary < high)
    return test


def salary_band(salary: Column) -> Column:
    """Name of the salary band, null where there is no salary."""
    label = F.lit(None).cast("string")
    for name, (low, high) in reversed(SALARY_BANDS.items()):
        label = F.when(in_band(salary, low, high), F.lit(name)).otherwise(label)
    return label
