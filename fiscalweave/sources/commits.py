"""Numbered commits: what readers see of a table changes by folders that are created at most once.

A commit is a few rows in a folder ``version=N`` below a log. It is written aside and then renamed
to the next number without overwriting, so of two writers that start from one state only one gets
the number; the other sees what was committed in the meantime and either goes on or gives up. The
log is itself a parquet table partitioned by version. Nothing here touches the data it points to.

The log must lie on a file system whose rename refuses an existing target: HDFS and its kin, or a
shared POSIX mount. Plain object stores do not give that.
"""

from __future__ import annotations

import errno
import os
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class CommitConflict(RuntimeError):
    """Another writer has committed for the same keys since the state this one started from."""


def _path(spark: SparkSession, path: str):
    """(Hadoop file system, path)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.sc().hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _path(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens where there is none."""
    fs, at = _path(spark, path)
    fs.delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path; none where it does not exist."""
    fs, at = _path(spark, path)
    if not fs.exists(at):
        return []
    return [s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory()]


def newest(spark: SparkSession, path: str) -> float:
    """When a folder or anything below it was last written, in seconds since 1970."""
    fs, at = _path(spark, path)
    times, todo = [fs.getFileStatus(at).getModificationTime()], [at]
    while todo:
        for status in fs.listStatus(todo.pop()):
            times.append(status.getModificationTime())
            if status.isDirectory():
                todo.append(status.getPath())
    return max(times) / 1000


def create_by_rename(spark: SparkSession, source: str, target: str) -> bool:
    """Give a written folder a name that nobody has; False where another writer was first."""
    fs, to = _path(spark, target)
    begin = spark._jvm.org.apache.hadoop.fs.Path(source)
    if fs.getUri().getScheme() == "file":
        try:  # refuses a target folder that is not empty, in one step
            os.rename(begin.toUri().getPath(), to.toUri().getPath())
        except OSError as error:
            if error.errno in (errno.ENOTEMPTY, errno.EEXIST):
                return False
            raise
        return True
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(),
                                                spark._jsc.sc().hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(begin), fs.makeQualified(to), options)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


@dataclass(frozen=True)
class CommitLog:
    """The commits of one table; ``keys`` name the columns that tell what a commit is about."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]

    def versions(self) -> list[int]:
        names = folders(self.spark, self.path)
        return sorted(int(n[len("version="):]) for n in names if n.startswith("version="))

    def head(self) -> int:
        """The number of the last commit; 0 before the first."""
        return max(self.versions(), default=0)

    def read(self, upto: int | None = None) -> DataFrame:
        """All committed rows with their version, of the state after commit ``upto``."""
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.LongType())])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.path)
        return rows if upto is None else rows.filter(F.col("version") <= upto)

    def commit(self, rows: DataFrame, base: int | None = None) -> int:
        """Commit a few rows on top of version ``base`` and return the new version.

        Versions that others have committed since ``base`` are looked at in turn: one that shares
        a key with ``rows`` is a conflict, and nothing is committed; after others the next number
        is tried. Without ``base`` the rows depend on no earlier state and never conflict.
        """
        staged = f"{self.path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
        rows = rows.select(*self.schema.names)
        rows.coalesce(1).write.parquet(staged)
        written = self.spark.read.schema(self.schema).parquet(staged)
        seen = self.head() if base is None else base
        while not create_by_rename(self.spark, staged, f"{self.path.rstrip('/')}/version={seen + 1}"):
            seen += 1
            if base is None:
                continue
            other = self.read().filter(F.col("version") == seen)
            if other.join(written, list(self.keys), "left_semi").head(1):
                remove(self.spark, staged)
                raise CommitConflict(f"{self.path}: version {seen} has changed the same "
                                     f"{', '.join(self.keys)} since version {base}")
        return seen + 1


def attempts_below(spark: SparkSession, table: str, depth: int = 4) -> Iterator[tuple[str, str]]:
    """(attempt, folder) of the folders ``attempt=...`` of a table, above other partitions or
    below them."""
    for name in folders(spark, table):
        here = f"{table}/{name}"
        if name.startswith("attempt="):
            yield name[len("attempt="):], here
        elif "=" in name and depth > 1:
            yield from attempts_below(spark, here, depth - 1)


def remove_dead_attempts(spark: SparkSession, tables: Sequence[str], live: set[str],
                         older_than: float, staged_in: Sequence[str] = ()) -> list[str]:
    """Delete the folders of attempts that are not ``live`` and, in the logs ``staged_in``, commits
    that were written and never numbered; returns what was deleted.

    Folders written to within the last ``older_than`` seconds stay: they may belong to a run that
    has not committed yet, or to a reader that began before the last commit.
    """
    before = time.time() - older_than
    dead = [folder for table in tables for attempt, folder in attempts_below(spark, table)
            if attempt not in live]
    dead += [f"{log}/{n}" for log in staged_in for n in folders(spark, log)
             if n.startswith("_staged-")]
    gone = [folder for folder in dead if newest(spark, folder) <= before]
    for folder in gone:
        remove(spark, folder)
    return gone
