"""Small files of writers and markers through Hadoop's FileSystem, so that they lie where Spark's data lies, whatever the scheme."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):  # noqa: ANN201
    """The file system of a path, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.setWriteChecksum(False)  # no files of sums beside small ones
    return fs, place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = at(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder, in order; none if there is no folder."""
    fs, place = at(spark, folder)
    return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or none."""
    fs, place = at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _put(fs, place, text: str) -> None:  # noqa: ANN001
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file as a whole: written beside its place and renamed over it, so a reader never sees a part."""
    fs, place = at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    _put(fs, beside, text)
    if not fs.rename(beside, place):  # most file systems do not rename over what is there
        fs.delete(place, False)
        if not fs.rename(beside, place):
            raise OSError(f"could not write {path}")


def append_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, with its folders; one that is there stays."""
    fs, place = at(spark, path)
    if not fs.exists(place):
        beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
        _put(fs, beside, text)
        fs.rename(beside, place)


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """A new small file as a whole, unless one is there: written beside its place and renamed, which fails where another was faster."""
    fs, place = at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    _put(fs, beside, text)
    if fs.exists(place) or not fs.rename(beside, place):
        fs.delete(beside, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> bool:
    fs, place = at(spark, path)
    return fs.delete(place, True)
