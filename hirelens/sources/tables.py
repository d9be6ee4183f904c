"""Catalog tables, and snapshots of whole databases."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.sources.versions import CommitConflict, Versions
from hirelens.workspace import at_once, remove

SYSTEM_DATABASES = {"information_schema", "mysql", "performance_schema", "sys"}
# Columns of a snapshot besides a table's own.
HASH, PART = "_hash", "_part"


def user_databases(spark: SparkSession) -> list[str]:
    """Names of the databases that are not part of the system."""
    return sorted(db.name for db in spark.catalog.listDatabases() if db.name not in SYSTEM_DATABASES)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_table_from_csv(spark: SparkSession, table: str, schema: T.StructType, path: str) -> DataFrame:
    """Create a parquet table, load a CSV file into it, return the table."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    spark.read.schema(schema).csv(path, header=True, quote='"', escape='"').write.insertInto(table)
    return spark.table(table)


def save_tables(tables: Mapping[str, DataFrame], database: str, buckets: Mapping[str, tuple[int, str | list[str]]] | None = None):
    """Save every frame as a table of the database, replacing an older one.

    `buckets` maps a table to (number of buckets, column). Tables bucketed alike on their join
    column are joined without a shuffle; pick a column whose values are spread evenly, like an id.
    """
    def save(name: str, df: DataFrame) -> None:
        if buckets and name in buckets:
            count, by = buckets[name]
            columns = [by] if isinstance(by, str) else list(by)
            # One task per bucket writes one file; without this every task writes to every bucket.
            writer = df.repartition(count, *columns).write.bucketBy(count, *columns).sortBy(*columns)
        else:
            writer = df.write
        writer.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")

    at_once(lambda name=name, df=df: save(name, df) for name, df in tables.items())


def read_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {t.name: spark.table(f"`{database}`.`{t.name}`")
            for t in spark.catalog.listTables(database) if not t.isTemporary}


def write_jdbc(tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str], connections: int = 8) -> None:
    """Append every frame to the table of the same name in a relational database.

    `connections` bounds how many tasks write at once; rows go over in batches.
    """
    for name, df in tables.items():
        (df.write.mode("append").option("numPartitions", connections).option("batchsize", 10_000)
         .jdbc(url, name, properties=dict(properties)))


def _buckets(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets of a table and the columns that deal rows out, if it has any."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in told:
        return None
    return int(told["Num Buckets"]), re.findall(r"`([^`]+)`", told["Bucket Columns"])


def _hashed(df: DataFrame, parts: int) -> DataFrame:
    """`df` with its row's hash and the part that it belongs to."""
    # Hashes pass over nulls, so whether there is one is hashed, too.
    told = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return df.withColumn(HASH, F.xxhash64(*told)).withColumn(PART, F.pmod(F.xxhash64(F.lit("part"), *told), F.lit(parts)))


def _contents(df: DataFrame, parts: int) -> dict[str, str]:
    """A hash of the rows of every part of a table, whatever their order."""
    found = _hashed(df, parts).groupBy(PART).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(HASH).cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit("xor"), HASH)).alias("x"))
    return {str(r[PART]): f"{r.n}:{r.s}:{r.x}" for r in found.collect()}  # one row per part


def snapshot(spark: SparkSession, database: str, path: str, rows_per_part: int = 1_000_000) -> list[str]:
    """Write the database below `path` as a new version; return the names of its tables.

    Rows belong to parts by a hash of their values. The manifest of a version lists for every part a hash of its content and the folder that
    has it, so a part that the last version has, too, is only listed again (`written` counts the others). A version counts only when
    its manifest is there, and the one that commits last is the last one, whatever the clocks say. A snapshot that is cut off changes nothing.
    """
    tables, versions, folder = read_tables(spark, database), Versions(spark, path), uuid.uuid4().hex

    def save(name: str, df: DataFrame, before: dict) -> dict:
        columns = [f"{n} {t}" for n, t in df.dtypes]
        same = before.get("columns") == columns
        parts = before["parts"] if same else max(1, -(-df.count() // rows_per_part))
        contents = _contents(df, parts)
        known = before["content"] if same else {}
        content = {k: known[k] if known.get(k, [None])[0] == told else [told, f"{folder}/{name}"] for k, told in contents.items()}
        changed = [int(k) for k, (_, at) in content.items() if at.startswith(folder)]
        if changed:
            (_hashed(df, parts).filter(F.col(PART).isin(changed)).drop(HASH).repartition(PART)
             .write.partitionBy(PART).parquet(f"{path}/{folder}/{name}"))
        bucketed = _buckets(spark, f"`{database}`.`{name}`")
        return {"columns": columns, "schema": df.schema.json(), "parts": parts, "content": content, "written": len(changed), "buckets": bucketed}

    while True:
        number, entry = versions.last()
        before = (entry or {"tables": {}})["tables"]
        done = dict(zip(tables, at_once(lambda n=n, df=df: save(n, df, before.get(n, {})) for n, df in tables.items())))
        try:
            versions.commit(number, {"tables": done})
            return sorted(done)
        except CommitConflict:  # compare with the new last one
            remove(spark, f"{path}/{folder}")


def restore(spark: SparkSession, path: str, database: str, location: str | None = None) -> list[str]:
    """Bring the database to the state of the last finished snapshot; return the table names.

    All tables are loaded beside the present ones first, buckets included. Only then each takes the place of its
    predecessor, and tables that the snapshot does not have are dropped.
    """
    told = Versions(spark, path).last()[1]["tables"]
    create_database(spark, database, location)
    new = f"_restored_{uuid.uuid4().hex}"

    def load(entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        folders = [f"{path}/{at}/{PART}={part}" for part, (_, at) in sorted(entry["content"].items())]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    save_tables({f"{name}{new}": load(entry) for name, entry in told.items()}, database,
                {f"{name}{new}": tuple(entry["buckets"]) for name, entry in told.items() if entry["buckets"]})
    for name in read_tables(spark, database):
        if not name.endswith(new):
            spark.sql(f"DROP TABLE `{database}`.`{name}`")
    for name in told:
        spark.sql(f"ALTER TABLE `{database}`.`{name}{new}` RENAME TO `{database}`.`{name}`")
    return sorted(told)
