"""Versions of a folder's content, of which each is committed by one writer only.

A content lies in a folder of its own, under a name nobody else uses. It becomes version
n when a folder with a note of that name is renamed to `versions/n`. A rename takes
effect at once; where `versions/n` is there already, the newcomer lands inside it (or
fails), where it does not count. So of two writers of one version one loses, and knows.
The store needs a rename that takes effect at once, as HDFS and local disks have.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


class ConcurrentChange(RuntimeError):
    """Another writer has committed a version in the meantime."""


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)


def _entries(spark: SparkSession, path: str) -> list:
    fs, place = _fs(spark, path)
    return list(fs.listStatus(place)) if fs.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, place = _fs(spark, path)
    fs.delete(place, True)


def new_content(path: str) -> str:
    """A folder for the next content."""
    return f"{path}/content-{uuid.uuid4().hex}"


def committed(spark: SparkSession, path: str) -> dict[int, str]:
    """The folder of every version that is kept, in order."""
    numbers = sorted(int(e.getPath().getName()) for e in _entries(spark, f"{path}/versions"))
    found = {}
    for n in numbers:
        notes = [e.getPath().getName() for e in _entries(spark, f"{path}/versions/{n}") if e.isFile()]
        if notes:
            found[n] = f"{path}/{notes[0]}"
    return found


def newest(spark: SparkSession, path: str) -> int | None:
    """The number of the last version, None without any."""
    return max((int(e.getPath().getName()) for e in _entries(spark, f"{path}/versions")), default=None)


def commit(spark: SparkSession, path: str, content: str, expected: int | None = None) -> int:
    """Make a written content the next version, and return its number.

    With `expected`, the version that the content was made from (0 for none), it is
    refused with `ConcurrentChange` if another one came after that. Without, it becomes
    the version after whatever other writers commit.
    """
    while True:
        last = newest(spark, path) or 0
        if expected is not None and last != expected:
            raise ConcurrentChange(f"{path}: version {last} is there, {expected} was expected")
        if _note(spark, path, last + 1, content.rsplit("/", 1)[1]):
            return last + 1


def _note(spark: SparkSession, path: str, version: int, name: str) -> bool:
    """Note a content as a version; whether it was the first."""
    staged = f"_note-{uuid.uuid4().hex}"
    fs, place = _fs(spark, f"{path}/{staged}/{name}")
    fs.create(place).close()
    target = f"{path}/versions/{version}"
    fs.mkdirs(_fs(spark, f"{path}/versions")[1])
    fs.rename(_fs(spark, f"{path}/{staged}")[1], _fs(spark, target)[1])
    won = exists(spark, f"{target}/{name}")
    if not won:
        _delete(spark, f"{path}/{staged}")
        _delete(spark, f"{target}/{staged}")
    return won


def drop_old(spark: SparkSession, path: str, keep: int, orphan_hours: float = 24) -> None:
    """Remove all but the last `keep` versions, and contents that lost runs left behind.

    The note goes before the content, so nobody starts to read what is being removed. A
    content without a note is removed once it is `orphan_hours` old: until then its
    writer may still be at work.
    """
    versions = committed(spark, path)
    for n, folder in list(versions.items())[: -keep if keep else None]:
        _delete(spark, f"{path}/versions/{n}")
        _delete(spark, folder)
    noted = {folder.rsplit("/", 1)[1] for folder in versions.values()}
    oldest = (time.time() - orphan_hours * 3600) * 1000
    for entry in _entries(spark, path):
        name = entry.getPath().getName()
        if name.startswith(("content-", "_note-")) and name not in noted and entry.getModificationTime() < oldest:
            _delete(spark, f"{path}/{name}")
