"""Where intermediate tables go: a folder that every executor can read."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Spark then deletes the shuffle files of a query at its end, and not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The folder of a local session without the setting.
_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session may run without the setting; it gets a fresh temporary folder.
    """
    path = spark.conf.get(SETTING, None)
    if path:
        return path.rstrip("/")
    # `local-cluster` has executors in processes of their own.
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="hirelens-"))
    return _OWN[0]


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, clean: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    The written table cuts the lineage, survives the loss of executors, and gives Catalyst a
    measured size, so later joins broadcast it only when it really is small. With `clean` the shuffle files
    go as soon as it is written, so steps that move much data do not pile them up.
    """
    spark, path = df.sparkSession, new_dir(df.sparkSession, label)
    before = spark.conf.get(CLEANUP)
    if clean:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if clean:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, name: str) -> tuple:
    """The file system of a file or folder, and its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    files, path = _file(spark, name)
    return files.exists(path)


def listed(spark: SparkSession, name: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    files, path = _file(spark, name)
    return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []


def size_of(spark: SparkSession, name: str) -> int:
    """Bytes of all files in a folder."""
    files, path = _file(spark, name)
    return files.getContentSummary(path).getLength()


def read_text(spark: SparkSession, name: str) -> str:
    """The whole of a small file."""
    files, path = _file(spark, name)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, name: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    files, path = _file(spark, name)
    stream = files.create(path, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def remove(spark: SparkSession, name: str) -> None:
    """Remove a file or folder, if it is there."""
    files, path = _file(spark, name)
    files.delete(path, True)


def unstage(staged: DataFrame) -> None:
    """Remove the table behind a frame that `stage` returned, once nothing reads it any more."""
    for folder in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
        remove(staged.sparkSession, folder)


def at_once(jobs: Iterable[Callable[[], object]]) -> list:
    """Run independent Spark jobs side by side, so that small ones do not leave the cluster idle."""
    jobs = list(jobs)
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(jobs)))) as pool:
        return list(pool.map(lambda job: job(), jobs))
