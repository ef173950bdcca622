"""Versions of a store, of which each number is claimed by exactly one writer.

A store has its data below ``root/data`` under names nobody else uses, and one small file per version in
``root/pointer``. The pointer file of a version is written whole under a hidden name and then moved to its
final name, which must not exist yet: of two writers that started from the same version one gets the
number, the other one learns that it was late and can read and merge again. Moving without
replacing is atomic on HDFS and, by a hard link, on a shared file system; on an object store that can't
move so, writers have to be kept apart by other means.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadtime.sources.files import read_or_empty

POINTER = "version bigint, path string"


def _versions(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/pointer", POINTER, "json")


def last_version(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """Number and path of the newest version; 0 and None before the first one."""
    row = _versions(spark, root).agg(F.max("version").alias("version"), F.max_by("path", "version").alias("path")).first()
    return row["version"] or 0, row["path"]


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest committed version, None before the first one."""
    return last_version(spark, root)[1]


def claim(spark: SparkSession, root: str, version: int, path: str) -> bool:
    """Name ``path`` as this version; False if another writer was first."""
    content, name = json.dumps({"version": version, "path": path}) + "\n", f"{version:012d}.json"
    place = urlparse(root)
    if place.scheme in ("", "file"):
        folder = f"{unquote(place.path)}/pointer"
        os.makedirs(folder, exist_ok=True)
        hidden = f"{folder}/.{uuid.uuid4().hex}"
        with open(hidden, "w") as file:
            file.write(content)
        try:
            os.link(hidden, f"{folder}/{name}")
        except FileExistsError:
            return False
        finally:
            os.unlink(hidden)
        return True
    jvm = spark._jvm
    hidden, final = (jvm.org.apache.hadoop.fs.Path(f"{root}/pointer/{n}") for n in (f".{uuid.uuid4().hex}", name))
    store = hidden.getFileSystem(spark._jsc.hadoopConfiguration())
    out = store.create(hidden, False)
    out.write(bytearray(content.encode()))
    out.close()
    moved = store.rename(hidden, final)  # False if the name exists
    if not moved:
        store.delete(hidden, False)
    return moved


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing refers to any more; none there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def data_path(root: str) -> str:
    return f"{root}/data/{uuid.uuid4().hex}"


@contextmanager
def new_version(spark: SparkSession, root: str) -> Iterator[str]:
    """A folder to write to, which becomes the next version when the block ends without an error.

    For contents that don't depend on the version before: a number that is taken is followed by the next one.
    """
    path = data_path(root)
    yield path
    version = last_version(spark, root)[0] + 1
    while not claim(spark, root, version, path):
        version += 1


def commit_version(df: DataFrame, root: str) -> str:
    """Write a store as the next version below ``root`` and return its path; older versions stay readable."""
    with new_version(df.sparkSession, root) as path:
        df.write.parquet(path)
    return path


def commit_merged(spark: SparkSession, root: str, merge: Callable[[str | None], str], tries: int = 20) -> str:
    """Commit what ``merge`` makes of the current version (its path, None at first) and returns the path of.

    If another writer commits meanwhile, its version is read and merged again, so nothing of either is lost.
    """
    for _ in range(tries):
        version, before = last_version(spark, root)
        path = merge(before)
        if claim(spark, root, version + 1, path):
            return path
    raise RuntimeError(f"{root}: other writers were first {tries} times")
