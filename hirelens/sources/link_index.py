"""The key index of the links that every day brought, so that a new day reads only what it may share with others."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.links import link_key
from hirelens.sources.key_index import KEY, KeyIndex


class LinkIndex:
    """The index below `path`, with one entry a day; `buckets` and `blocks` are those of `KeyIndex`."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, blocks: int = 1 << 14) -> None:
        self.path = path
        self.index = KeyIndex(spark, path, buckets, blocks, "crawl_date")
        self.buckets, self.blocks = self.index.buckets, self.index.blocks

    def put(self, day: datetime.date, keys: DataFrame) -> None:
        """Let the day have just these keys (column `_key`)."""
        self.index.put(day.isoformat(), keys)

    def add(self, day: datetime.date, keys: DataFrame) -> None:
        """Give the day these keys, too; adding keys again changes nothing."""
        self.index.add(day.isoformat(), keys)

    def has_day(self, day: datetime.date) -> bool:
        return day.isoformat() in self.index.entries()

    def last_day(self) -> datetime.date | None:
        """The last day that has an entry; only folders are listed."""
        days = self.index.entries()
        return datetime.date.fromisoformat(days[-1]) if days else None

    def segments(self, keys: DataFrame, day: datetime.date) -> list[tuple[datetime.date, int]]:
        """(day, bucket) of all buckets of other days that may hold one of the keys."""
        others = [entry for entry in self.index.entries() if entry != day.isoformat()]
        return [(datetime.date.fromisoformat(entry), bucket) for entry, bucket in self.index.segments(keys, others)]

    def read(self, segments: list[tuple[datetime.date, int]]) -> DataFrame:
        """The keys of some buckets."""
        return self.index.read([(day.isoformat(), bucket) for day, bucket in segments])

    def known(self, keys: DataFrame, day: datetime.date) -> DataFrame:
        """Those of the keys that belong to another day."""
        return keys.select(KEY).join(self.read(self.segments(keys, day)), KEY, "left_semi")

    def build(self, rows: DataFrame) -> None:
        """Index a table (crawl_date, group, link) that has none yet, a day at a time."""
        for r in rows.select("crawl_date").distinct().orderBy("crawl_date").collect():
            self.put(r.crawl_date, rows.filter(F.col("crawl_date") == F.lit(r.crawl_date)).select(link_key().alias(KEY)))
