"""Which postings to keep: new links, first copies, at most N per group, no blocked pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.fixed_values import BLOCKED_PAGE, BRAND_LINK, POSTINGS_PER_GROUP
from hirelens.functions.pages import page_title
from hirelens.functions.text import strip

LINK_KEY = ["group", "link"]


def first_per_key(df: DataFrame, order: Sequence[str], keys: Sequence[str] = LINK_KEY) -> DataFrame:
    """The first row of every key in the given order.

    Each task cuts its rows down to one per key before the shuffle, so a key with very many
    copies sends one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def cap_per_group(
    df: DataFrame, order: Sequence[str], n: int = POSTINGS_PER_GROUP, group: str = "group", salts: int = 64
) -> DataFrame:
    """The first `n` rows of every group in the given order.

    `order` must give every row of a group its own place. A group is first cut to `n` rows in
    each of `salts` slices, because the first `n` of the group are among the first `n` of the
    slices. No task then sees more than `n * salts` rows of one group.
    """
    slice_of = F.pmod(F.xxhash64(*order), F.lit(salts))
    sliced = Window.partitionBy(group, "_slice").orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("_slice", slice_of)
        .withColumn("_rank", F.row_number().over(sliced))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= n)
        .drop("_slice", "_rank")
    )


def link_key() -> Column:
    """One text that is equal only for equal (group, link), null included."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.concat(*[part(F.col(k)) for k in LINK_KEY])


def new_links(df: DataFrame, seen: DataFrame, order: Sequence[str]) -> DataFrame:
    """First copy of every (group, link) that `seen` does not hold.

    First copies and join share one key, so each side is shuffled once, and `seen` with its keys only.
    """
    known = seen.select(link_key().alias("_key"))
    return first_per_key(df.withColumn("_key", link_key()), order, ["_key"]).join(known, "_key", "left_anti").drop("_key")


def without_links(df: DataFrame, marker: str = BRAND_LINK, link: str = "link") -> DataFrame:
    """Rows whose link does not hold the marker."""
    return df.filter(~F.col(link).contains(marker))


def only_group(df: DataFrame, name: str) -> DataFrame:
    """Rows of one group, letter case ignored."""
    return df.filter(F.lower(strip(F.col("group"))) == name.lower())


def not_blocked(pages: DataFrame, marker: str = BLOCKED_PAGE) -> DataFrame:
    """Pages whose title does not say that the visitor was stopped."""
    return pages.filter(~F.lower(page_title(F.col("html"))).contains(marker.lower()))
