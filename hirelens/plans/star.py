"""From cleaned postings to the relational model: two dimensions, the jobs, their texts, two bridges."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.functions.text import strip
from hirelens.plans.guard import ConstraintError, Guard
from hirelens.sources.versions import FOLDER, CommitConflict, Versions
from hirelens.workspace import at_once, listed, remove, size_of, stage, unstage

TABLES = ["skill_groups", "skills", "skill_details", "jobs", "job_details", "job_skills"]
JOB_COLUMNS = [
    "title", "link", "location", "experience", "work_location_detail", "working_time", "deadline",
    "salary_raw", "salary_normalized", "currency_unit",
]
TEXT_COLUMNS = ["description", "requirements", "benefits"]
# The folder of a saved model that holds the indexes of its keys.
KEYS = "_keys"

# Dimensions of so many names are sent to every task.
FEW_NAMES = 100_000

# monotonically_increasing_id() keeps the number of the partition above this many bits.
ROW_BITS = 33


def dense_ids(names: DataFrame, column: str = "name", after: int = 0) -> DataFrame:
    """(id, column): the different values of `column`, numbered from `after + 1` in their order.

    The values are sorted across the cluster and numbered within their partition. Only one
    number per partition, its size, is then summed up in a single task.
    """
    numbered = (
        names.repartitionByRange(column).sortWithinPartitions(column)
        .select(column, F.monotonically_increasing_id().alias("_row"))
    )
    placed = stage(numbered, "ids").select(
        column,
        F.shiftright("_row", ROW_BITS).alias("_part"),
        F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1)).alias("_index"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part").agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of the sort: small for any amount of data.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_index") + 1 + after).cast("bigint").alias("id"), column)


def name_key(name: Column, case_blind: bool = False) -> Column:
    """What tells two names of a dimension apart."""
    key = strip(F.coalesce(name, F.lit("")))
    return F.lower(key) if case_blind else key


def dimension(names: DataFrame, case_blind: bool = False) -> DataFrame:
    """(id, name) for the column `name`; with `case_blind` the first spelling stands for all."""
    if not case_blind:
        return dense_ids(names.select(name_key(F.col("name")).alias("name")).distinct())
    spellings = (
        names.groupBy(name_key(F.col("name"), True).alias("_key"))
        .agg(F.min(name_key(F.col("name"))).alias("name"))
    )
    return dense_ids(spellings.select("name"))


def group_names(postings: DataFrame) -> DataFrame:
    return postings.select(F.col("group").alias("name"))


def skill_names(postings: DataFrame) -> DataFrame:
    return postings.select(F.explode("skills").alias("name")).filter(strip(F.col("name")) != "")


def missing_names(existing: DataFrame, names: DataFrame, case_blind: bool = False) -> DataFrame:
    """(id, name) for the names that `existing` does not have, numbered from its last id on."""
    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", name_key(F.col("name"), case_blind))

    missing = (
        keyed(names).groupBy("_key").agg(F.min(name_key(F.col("name"))).alias("name"))
        .join(keyed(existing).select("_key"), "_key", "left_anti")
    )
    last = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).first()["last"]
    return dense_ids(missing.select("name"), after=last)


def upsert_dimension(existing: DataFrame, names: DataFrame, case_blind: bool = False) -> DataFrame:
    """`existing` with the missing names added under new ids; ids in use stay as they are."""
    return existing.select("id", "name").unionByName(missing_names(existing, names, case_blind))


def with_job_ids(postings: DataFrame) -> DataFrame:
    """Postings with a `job_id`: the one they have, else a 128-bit hash of the whole row.

    The hash makes a load repeatable, and postings equal in every column become one.
    """
    if "job_id" in postings.columns:
        return postings
    row = F.to_json(F.struct(*sorted(postings.columns)), {"ignoreNullFields": "false"})
    return postings.withColumn("job_id", F.md5(row)).dropDuplicates(["job_id"])


def _lookup(dim: DataFrame, id_name: str, case_blind: bool) -> DataFrame:
    return dim.select(F.col("id").alias(id_name), name_key(F.col("name"), case_blind).alias(f"_{id_name}_key"))


def _by_count(dim: DataFrame) -> DataFrame:
    """A stored dimension, to be sent to every task if its names are few.

    Left to the sizes, Catalyst would rather send all postings: in files they are small, and in memory they are not.
    """
    return F.broadcast(dim) if dim.count() <= FEW_NAMES else dim.hint("merge")


def jobs(postings: DataFrame, groups: DataFrame, case_blind: bool = False) -> DataFrame:
    lookup = _lookup(groups, "group_id", case_blind)
    return (
        postings.withColumn("_group_id_key", name_key(F.col("group"), case_blind))
        .join(lookup, "_group_id_key")
        .select(F.col("job_id").alias("id"), "group_id", *JOB_COLUMNS)
    )


def job_details(postings: DataFrame) -> DataFrame:
    """The long texts of every job; one row per job, so the job's id serves as its own."""
    return postings.select(F.col("job_id").alias("id"), "job_id", *TEXT_COLUMNS)


def _pairs(postings: DataFrame, case_blind: bool) -> DataFrame:
    keys = F.array_distinct(F.transform("skills", lambda s: name_key(s, case_blind)))
    return postings.select(
        "job_id",
        name_key(F.col("group"), case_blind).alias("_group_id_key"),
        F.explode(keys).alias("_skill_id_key"),
    )


def job_skills(postings: DataFrame, skills: DataFrame, case_blind: bool = False) -> DataFrame:
    """(job_id, skill_id), each pair once: a job's skills are made different within its row."""
    lookup = _lookup(skills, "skill_id", case_blind)
    return _pairs(postings, case_blind).join(lookup, "_skill_id_key").select("job_id", "skill_id")


def skill_details(postings: DataFrame, groups: DataFrame, skills: DataFrame, case_blind: bool = False) -> DataFrame:
    """(skill_id, group_id), each pair once: names are made different before the lookups."""
    return (
        _pairs(postings, case_blind).select("_group_id_key", "_skill_id_key").distinct()
        .join(_lookup(skills, "skill_id", case_blind), "_skill_id_key")
        .join(_lookup(groups, "group_id", case_blind), "_group_id_key")
        .select("skill_id", "group_id")
    )


def build_star(postings: DataFrame, case_blind: bool = False) -> dict[str, DataFrame]:
    """The six tables for cleaned postings, whose `skills` is an array of names."""
    postings = with_job_ids(postings)
    def stored(names: DataFrame) -> DataFrame:
        numbered = dimension(names, case_blind)
        kept = stage(numbered, "names")
        unstage(numbered)
        return kept

    dims = at_once([lambda: stored(group_names(postings)), lambda: stored(skill_names(postings))])
    groups, skills = map(_by_count, dims)
    return {
        "skill_groups": dims[0],
        "skills": dims[1],
        "skill_details": skill_details(postings, groups, skills, case_blind),
        "jobs": jobs(postings, groups, case_blind),
        "job_details": job_details(postings),
        "job_skills": job_skills(postings, skills, case_blind),
    }


def rejoin(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The postings the tables were made from, with sorted and different skills."""
    groups = tables["skill_groups"].select(F.col("id").alias("group_id"), F.col("name").alias("group"))
    named = tables["job_skills"].join(
        tables["skills"].select(F.col("id").alias("skill_id"), "name"), "skill_id")
    lists = named.groupBy("job_id").agg(F.sort_array(F.collect_set("name")).alias("skills"))
    parts = [
        tables["jobs"].join(groups, "group_id").withColumnRenamed("id", "job_id").drop("group_id"),
        tables["job_details"].drop("id"),
        lists,
    ]
    whole = reduce(lambda a, b: a.join(b, "job_id", "left"), parts)
    return whole.withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))


def _write(tables: Mapping[str, DataFrame], path: str) -> str:
    """Write all tables into a new folder, which no version has yet; return its name."""
    folder = uuid.uuid4().hex
    at_once(lambda name=name: tables[name].write.parquet(f"{path}/{folder}/{name}") for name in TABLES)
    return folder


def _parts(spark: SparkSession, path: str, parts: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(*[f"{path}/{part}/{name}" for part in parts]) for name in TABLES}


def save_star(tables: Mapping[str, DataFrame], path: str) -> str:
    """Write all tables into a new folder and make it the whole model, only when all are written; return the folder."""
    spark = tables["jobs"].sparkSession
    folder, versions = _write(tables, path), Versions(spark, path)
    while True:  # it takes the place of any version
        with contextlib.suppress(CommitConflict):
            versions.commit(versions.last()[0], {"parts": [folder]})
            return folder


def current_parts(spark: SparkSession, path: str) -> list[str]:
    """The folders that make up the version committed last; half-written ones are never among them."""
    return list(Versions(spark, path).last()[1]["parts"])


def read_star(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the version committed last."""
    return _parts(spark, path, current_parts(spark, path))


def load_star(postings: DataFrame, path: str, case_blind: bool = False) -> dict[str, DataFrame]:
    """Write the postings out once, build the six tables from that copy, save and return them."""
    staged = stage(with_job_ids(postings), "postings")
    tables = build_star(staged, case_blind)
    save_star(tables, path)
    for df in (tables["skill_groups"], tables["skills"], staged):
        unstage(df)
    return read_star(postings.sparkSession, path)


def _added(staged: DataFrame, old: Mapping[str, DataFrame], case_blind: bool) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """What new postings add to each table of a model, and the staged frames that this reads."""
    def missing(kind: str, names: DataFrame) -> DataFrame:
        numbered = missing_names(old[kind], names, case_blind)
        kept = stage(numbered, "names")
        unstage(numbered)
        return kept

    new_groups, new_skills = at_once([
        lambda: missing("skill_groups", group_names(staged)), lambda: missing("skills", skill_names(staged))])
    groups = old["skill_groups"].select("id", "name").unionByName(new_groups)
    skills = old["skills"].select("id", "name").unionByName(new_skills)
    groups, skills = _by_count(groups), _by_count(skills)
    pairs = skill_details(staged, groups, skills, case_blind).join(old["skill_details"], ["skill_id", "group_id"], "left_anti")
    return {
        "skill_groups": new_groups,
        "skills": new_skills,
        "skill_details": pairs,
        "jobs": jobs(staged, groups, case_blind),
        "job_details": job_details(staged),
        "job_skills": job_skills(staged, skills, case_blind),
    }, [new_groups, new_skills]


def guard(spark: SparkSession, path: str) -> Guard:
    """The checks of what is added to a saved model; their indexes lie in the folder `_keys` of the model."""
    return Guard(spark, f"{path}/{KEYS}", lambda part: _parts(spark, path, [part]))


def extend_star(
    postings: DataFrame, path: str, case_blind: bool = False, tries: int = 10, check: bool = False
) -> dict[str, DataFrame]:
    """Add postings to a saved model and return it.

    Names and jobs that the model has keep their ids; only missing names, pairs and jobs are written, into a folder of
    their own, and become visible together. Loading the same postings again adds nothing. If another load commits in between, what is
    missing is worked out again on top of it, up to `tries` times, so none of two loads is lost. With `check` a load that would break a
    constraint of the model raises ConstraintError and adds nothing; of the model only buckets of keys are read for that.
    """
    spark, versions = postings.sparkSession, Versions(postings.sparkSession, path)
    given = stage(with_job_ids(postings), "given")
    try:
        for _ in range(tries):
            number, entry = versions.last()
            old = _parts(spark, path, entry["parts"])
            staged = stage(given.join(old["jobs"].select(F.col("id").alias("job_id")), "job_id", "left_anti"), "postings")
            added, scratch = _added(staged, old, case_blind)
            folder = _write(added, path)
            for df in (staged, *scratch):
                unstage(df)
            try:
                if check:
                    guard(spark, path).check(_parts(spark, path, [folder]), entry["parts"])
                versions.commit(number, {"parts": [*entry["parts"], folder]})
                return read_star(spark, path)
            except ConstraintError:
                remove(spark, f"{path}/{folder}")
                raise
            except CommitConflict:
                remove(spark, f"{path}/{folder}")
    finally:
        unstage(given)
    raise CommitConflict(f"{tries} other loads of {path} came first")


def compact_star(spark: SparkSession, path: str, most: int = 8, tries: int = 10) -> list[str]:
    """Merge the small parts of a model once there are more than `most`; return the parts it then has.

    A part with half of all bytes or more stays as it is, so the cost follows what was added. The tables hold the same rows before and
    after. Folders of earlier versions stay for those who still read them, until `drop_unused`.
    """
    versions = Versions(spark, path)
    for _ in range(tries):
        number, entry = versions.last()
        parts = entry["parts"]
        if len(parts) <= most:
            return list(parts)
        sizes = {part: size_of(spark, f"{path}/{part}") for part in parts}
        large = [part for part in parts if 2 * sizes[part] >= sum(sizes.values())]
        small = [part for part in parts if part not in large]
        folder = _write({name: df.hint("rebalance") for name, df in _parts(spark, path, small).items()}, path)
        try:
            versions.commit(number, {"parts": [*large, folder]})
            return [*large, folder]
        except CommitConflict:
            remove(spark, f"{path}/{folder}")
    raise CommitConflict(f"{tries} loads of {path} came first")


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Remove the folders that the present version does not have; call it only while nobody loads or reads an earlier one."""
    parts = current_parts(spark, path)
    used = {*parts, FOLDER, KEYS}
    gone = sorted(name for name in listed(spark, path) if name not in used)
    guard(spark, path).forget(parts)
    for name in gone:
        remove(spark, f"{path}/{name}")
    return gone
