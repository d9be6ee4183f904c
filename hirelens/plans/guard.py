"""The constraints of the relational model on what a load adds, without reading the tables it is added to.

For every unique key of a table the keys of each part are kept in a `KeyIndex`. New rows are checked against each other, and
against those hash buckets of the parts that may hold one of their keys; parents are looked up the same way by their id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.quality import counted, row_violations, unique_subject
from hirelens.schemas import FOREIGN_KEYS, UNIQUE_KEYS
from hirelens.sources.key_index import KEY, KeyIndex
from hirelens.workspace import at_once

Tables = Mapping[str, DataFrame]
SMALLEST, LARGEST = 1 << 6, 1 << 24


class ConstraintError(ValueError):
    """A load would break a constraint of the model."""


def key_of(key: Sequence[str], columns: Sequence[str] | None = None) -> Column:
    """The key as one text; values of `columns` stand for those of the key. Equal keys with nulls are equal, as in `violations`."""
    return F.to_json(F.struct(*[F.col(c).alias(k) for k, c in zip(key, columns or key)])).alias(KEY)


class Guard:
    """Checks additions to a model made of parts; its indexes lie below `path`.

    `read` gives the tables of one part. A part is indexed when it is first asked for and then never read again, and an index forgets
    parts that the model no longer has. The number of filter blocks follows the first part's rows, up to 16 million (some 0.6 GB):
    beyond that more buckets are read, with the same result. Loads that check run one at a time, since they share the indexes.
    """

    def __init__(self, spark: SparkSession, path: str, read: Callable[[str], Tables], buckets: int = 16) -> None:
        self.spark, self.path, self.read, self.buckets = spark, path, read, buckets

    def _index(self, table: str, key: Sequence[str], parts: Sequence[str]) -> KeyIndex:
        """The index of a key, with all these parts in it."""
        path = f"{self.path}/{table}-{'-'.join(key)}"
        index = KeyIndex(self.spark, path, self.buckets, label="part")
        missing = [part for part in parts if not index.has(part)]
        if missing and not index.made:
            rows = max(self.read(part)[table].count() for part in missing)
            blocks = min(max(1 << (rows // 16).bit_length(), SMALLEST, self.buckets), LARGEST)
            index = KeyIndex(self.spark, path, self.buckets, blocks, label="part")
        for part in missing:
            index.put(part, self.read(part)[table].select(key_of(key)))
        return index

    def forget(self, parts: Sequence[str]) -> None:
        """Drop what is kept for any other part; call it only while nobody checks against an earlier version."""
        for table, keys in UNIQUE_KEYS.items():
            for key in keys:
                index = KeyIndex(self.spark, f"{self.path}/{table}-{'-'.join(key)}", self.buckets, label="part")
                for part in set(index.entries()).difference(parts):
                    index.drop(part)

    def violations(self, added: Tables, parts: Sequence[str]) -> DataFrame:
        """(rule, subject, offending_rows) for what `added` breaks on top of these parts.

        If the parts by themselves break no rule, this is what `quality.violations` says of the parts and the additions together:
        for unique keys the number of keys on more than one row, else the number of rows.
        """
        indexes = dict(zip(
            subjects := [(table, tuple(key)) for table, keys in UNIQUE_KEYS.items() for key in keys],
            at_once([lambda t=table, k=key: self._index(t, k, parts) for table, key in subjects])))

        def unique(table: str, key: Sequence[str]) -> DataFrame:
            keys = added[table].select(key_of(key)).groupBy(KEY).agg(F.count("*").alias("copies"))
            held = indexes[table, tuple(key)].held(keys, parts).select(KEY, F.lit(True).alias("held"))
            bad = keys.join(held.distinct(), KEY, "left").filter((F.col("copies") > 1) | F.col("held"))
            return counted("unique", unique_subject(table, key), bad)

        def foreign(child: str, column: str, parent: str) -> DataFrame:
            rows = added[child].filter(F.col(column).isNotNull()).select(key_of(["id"], [column]))
            absent = rows.distinct().join(added[parent].select(key_of(["id"])), KEY, "left_anti")
            orphaned = absent.join(indexes[parent, ("id",)].held(absent, parts), KEY, "left_anti")
            return counted("foreign key", f"{child}.{column}", rows.join(orphaned, KEY, "left_semi"))

        checks = at_once([
            *[lambda t=table, k=key: unique(t, k) for table, key in subjects],
            *[lambda c=child, n=column, p=parent: foreign(c, n, p) for child, column, parent, _ in FOREIGN_KEYS],
        ])
        return reduce(DataFrame.unionByName, [*checks, *row_violations(added)])

    def check(self, added: Tables, parts: Sequence[str]) -> None:
        """Raise ConstraintError if `added` breaks a rule."""
        broken = self.violations(added, parts).filter("offending_rows > 0").orderBy("rule", "subject").collect()
        if broken:
            raise ConstraintError("; ".join(f"{r.rule} {r.subject}: {r.offending_rows}" for r in broken))
