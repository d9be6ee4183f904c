"""The constraints of the relational model as checks that return the offending rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.schemas import FOREIGN_KEYS, MAX_LENGTHS, REQUIRED, UNIQUE_KEYS

Tables = Mapping[str, DataFrame]


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., copies) of every key that stands on more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Child rows whose reference is set but has no parent row."""
    ids = parent.select(F.col("id").alias(column))
    return child.filter(F.col(column).isNotNull()).join(ids, column, "left_anti")


def lacks_value(columns: Sequence[str]) -> Column:
    """True for a row without a required value."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))


def is_too_long(limits: Mapping[str, int]) -> Column:
    """True for a row in which some text is longer than its column takes."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.char_length(c) > n, F.lit(False)) for c, n in limits.items()))


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that lack a required value."""
    return df.filter(lacks_value(columns))


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows in which some text is longer than its column takes."""
    return df.filter(is_too_long(limits))


def counted(rule: str, subject: str, bad: DataFrame) -> DataFrame:
    """(rule, subject, offending_rows) of one constraint."""
    return (bad.agg(F.count("*").alias("offending_rows"))
            .select(F.lit(rule).alias("rule"), F.lit(subject).alias("subject"), "offending_rows"))


def row_violations(tables: Tables) -> list[DataFrame]:
    """(rule, subject, offending_rows) of the constraints on single rows, one frame and one pass per table."""
    parts = []
    for table, columns in REQUIRED.items():
        rules = {"required": lacks_value(columns)}
        if table in MAX_LENGTHS:
            rules["length"] = is_too_long(MAX_LENGTHS[table])
        counts = tables[table].agg(F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("subject"), F.count_if(bad).alias("offending_rows"))
            for rule, bad in rules.items()]).alias("counts"))
        parts.append(counts.select(F.inline("counts")))
    return parts


def unique_subject(table: str, key: Sequence[str]) -> str:
    return f"{table}({', '.join(key)})"


def violations(tables: Tables) -> DataFrame:
    """(rule, subject, offending_rows) for every constraint of the model."""
    unique = [counted("unique", unique_subject(table, key), duplicate_keys(tables[table], key))
              for table, keys in UNIQUE_KEYS.items() for key in keys]
    foreign = [counted("foreign key", f"{child}.{column}", orphans(tables[child], column, tables[parent]))
               for child, column, parent, _ in FOREIGN_KEYS]
    return reduce(DataFrame.unionByName, [*unique, *foreign, *row_violations(tables)])


def delete_rows(tables: Tables, table: str, gone: DataFrame) -> dict[str, DataFrame]:
    """The tables after deleting the rows of `table` whose id is in `gone(id)`.

    Rows of child tables follow their parent where the model says so. Where it does not, a
    parent that still has children stays.
    """
    result = dict(tables)
    gone = gone.select("id")
    for child, column, parent, follows in FOREIGN_KEYS:
        if parent == table and not follows:
            used = result[child].select(F.col(column).alias("id")).distinct()
            gone = gone.join(used, "id", "left_anti")
    for child, column, parent, follows in FOREIGN_KEYS:
        if parent == table and follows:
            result[child] = result[child].join(gone.withColumnRenamed("id", column), column, "left_anti")
    result[table] = result[table].join(gone, "id", "left_anti")
    return result
