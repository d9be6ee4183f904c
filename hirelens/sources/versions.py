"""A log of numbered versions, in which a writer commits only on top of the version it has read."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from hirelens.workspace import listed, read_text, write_new

FOLDER = "_versions"


class CommitConflict(RuntimeError):
    """Another writer has committed since the version was read."""


class Versions:
    """Versions below `path`: one small JSON file each, numbered from 1.

    A version is committed by creating the file of the next number, which the file system lets one writer do only (HDFS does so;
    on an object store use one with conditional writes). So order depends on no clock, and whoever comes second learns of it.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.folder = spark, f"{path}/{FOLDER}"

    def last(self) -> tuple[int, dict | None]:
        """Number and entry of the version committed last, (0, None) if there is none. A half-written file is none yet."""
        for name in sorted((n for n in listed(self.spark, self.folder) if n.endswith(".json")), reverse=True):
            try:
                return int(name.split(".")[0]), json.loads(read_text(self.spark, f"{self.folder}/{name}"))
            except json.JSONDecodeError:
                continue
        return 0, None

    def commit(self, after: int, entry: dict) -> int:
        """Make `entry` the version after the given one, or raise CommitConflict if there is one already."""
        name = f"{self.folder}/{after + 1:012d}.json"
        try:
            write_new(self.spark, name, json.dumps(entry))
        except Py4JJavaError as error:
            if "FileAlreadyExists" in str(error.java_exception):
                raise CommitConflict(name) from None
            raise
        return after + 1
