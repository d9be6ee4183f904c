"""A stored index of keys by the entry (a day, a part of a table) that brought them, so that new keys read only what they may share.

    <path>/keys/<label>=E/bucket=B/     the keys that belong to the entry, in hash buckets
    <path>/filters/<label>=E/           (block, w0, w1, w2, w3): Bloom filters of the same keys, 256 bits a block

A key's hash gives its block, and the block its bucket. All eight bits of a key lie in one block, so probing is one join
of the new keys with rows of 36 bytes, which say which buckets of which entries may hold one. Only these are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.workspace import exists, listed, read_text, remove, stage, unstage, write_new

KEY = "_key"
WORDS = ["w0", "w1", "w2", "w3"]
PROBES = 8


def _place(blocks: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(blocks)).cast("int")


def _masks() -> list[Column]:
    """The words of a block with the key's bits set."""
    bits = F.xxhash64(F.lit("bits"), KEY)
    words: list[list[Column]] = [[] for _ in WORDS]
    for i in range(PROBES):
        at = F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255)).cast("int")
        one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)))
        for w, terms in enumerate(words):
            terms.append(F.when(F.shiftright(at, 6) == w, one).otherwise(F.lit(0).cast("long")))
    return [reduce(lambda a, b: a.bitwiseOR(b), terms) for terms in words]


class KeyIndex:
    """The index below `path`.

    `buckets` and `blocks` are those given when the index is made, for its whole life; a bucket should get some thousand keys of an entry, and
    a block about 16. More keys only make more buckets look as if they held one: what is known is decided by the keys themselves.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, blocks: int = 1 << 14, label: str = "entry") -> None:
        if blocks % buckets:
            raise ValueError("blocks must be a multiple of buckets")
        self.spark, self.path, self.buckets, self.blocks, self.label = spark, path, buckets, blocks, label
        self.made = exists(spark, self._settings())
        if self.made:
            self.buckets, self.blocks = json.loads(read_text(spark, self._settings()))

    def _settings(self) -> str:
        return f"{self.path}/settings.json"

    def _folder(self, kind: str, entry: str) -> str:
        return f"{self.path}/{kind}/{self.label}={entry}"

    def _write(self, entry: str, keys: DataFrame, mode: str) -> None:
        if not self.made:
            write_new(self.spark, self._settings(), json.dumps([self.buckets, self.blocks]))
            self.made = True
        placed = stage(keys.select(KEY).distinct().withColumn("block", _place(self.blocks)), "keys")
        filters = placed.select("block", *[m.alias(w) for m, w in zip(_masks(), WORDS)]).groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])
        # The filters follow the keys: a run that is cut off in between is repeated by its caller.
        (placed.withColumn("bucket", F.col("block") % self.buckets).repartition("bucket").sortWithinPartitions("bucket", KEY)
         .select(KEY, "bucket").write.mode(mode).partitionBy("bucket").parquet(self._folder("keys", entry)))
        filters.sort("block").write.mode(mode).parquet(self._folder("filters", entry))
        unstage(placed)

    def put(self, entry: str, keys: DataFrame) -> None:
        """Let the entry have just these keys (column `_key`)."""
        remove(self.spark, self._folder("filters", entry))
        self._write(entry, keys, "overwrite")

    def add(self, entry: str, keys: DataFrame) -> None:
        """Give the entry these keys, too; adding keys again changes nothing."""
        self._write(entry, keys, "append")

    def drop(self, entry: str) -> None:
        """Forget an entry."""
        for kind in ("filters", "keys"):
            remove(self.spark, self._folder(kind, entry))

    def has(self, entry: str) -> bool:
        return exists(self.spark, f"{self._folder('filters', entry)}/_SUCCESS")

    def entries(self) -> list[str]:
        """All entries in order; only folders are listed."""
        return sorted(name.split("=", 1)[1] for name in listed(self.spark, f"{self.path}/filters") if name.startswith(f"{self.label}="))

    def segments(self, keys: DataFrame, among: Iterable[str]) -> list[tuple[str, int]]:
        """(entry, bucket) of all buckets of these entries that may hold one of the keys."""
        wanted = sorted({*among}.intersection(self.entries()))
        if not wanted:
            return []
        schema = f"block int, {', '.join(f'{w} long' for w in WORDS)}, {self.label} string"
        filters = self.spark.read.schema(schema).option("basePath", f"{self.path}/filters").parquet(*[self._folder("filters", e) for e in wanted])
        probes = keys.select(_place(self.blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks())]).distinct()
        held = reduce(lambda a, b: a & b, (F.col(w).bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i, w in enumerate(WORDS)))
        found = filters.join(probes, "block").filter(held).select(self.label, (F.col("block") % self.buckets).alias("bucket")).distinct()
        return sorted((r[0], r[1]) for r in found.collect())  # bounded by the number of folders

    def read(self, segments: Iterable[tuple[str, int]]) -> DataFrame:
        """The keys of some buckets."""
        paths = [p for e, b in segments if exists(self.spark, p := f"{self._folder('keys', e)}/bucket={b}")]
        return self.spark.read.schema(f"{KEY} string").parquet(*paths) if paths else self.spark.createDataFrame([], f"{KEY} string")

    def held(self, keys: DataFrame, among: Iterable[str]) -> DataFrame:
        """Those of the keys that one of these entries has."""
        return keys.select(KEY).join(self.read(self.segments(keys, among)), KEY, "left_semi")
