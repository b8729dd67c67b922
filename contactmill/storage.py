"""Files and folders in any file system that Spark reaches; paths without a scheme are in its default one."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

from pyspark.sql import SparkSession

#: Characters of text that go to a file at once.
_PIECE = 1 << 20


def _at(spark: SparkSession, path: str):
    """(file system, path) with the scheme filled in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.setWriteChecksum(False)  # no files of checksums beside the outputs
    return system, system.makeQualified(place)


def uri(spark: SparkSession, path: str) -> str:
    """The path with scheme; local ones without links and dots, so that each file has one name."""
    whole = _at(spark, path)[1]
    return "file://" + os.path.realpath(whole.toUri().getPath()) if whole.toUri().getScheme() == "file" else whole.toString()


def name(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    system, place = _at(spark, pattern)
    return [s.getPath().toString() for s in system.globStatus(place) or []]


def make_folder(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file its place, instead of what is there."""
    system, place = _at(spark, source)
    remove(spark, target)
    if not system.rename(place, _at(spark, target)[1]):
        raise OSError(f"{source} -> {target}")


def write_text(spark: SparkSession, path: str, pieces: Iterable[str]) -> None:
    """Write a file of UTF-8 text, some of it at a time."""

    def joined() -> Iterator[str]:
        held, size = [], 0
        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size > _PIECE:
                yield "".join(held)
                held, size = [], 0
        yield "".join(held)

    system, place = _at(spark, path)
    stream = system.create(place, True)
    try:
        for text in joined():
            stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def join_files(spark: SparkSession, head: str, folder: str, target: str) -> None:
    """A file of the head and the part files of a folder in order; the bytes go through the driver's
    JVM a buffer at a time."""
    system, place = _at(spark, folder)
    parts = sorted(s.getPath().toString() for s in system.listStatus(place) if s.getPath().getName().startswith("part-"))
    tools = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
    out = system.create(_at(spark, target)[1], True)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            stream = system.open(_at(spark, part)[1])
            try:
                tools.copyBytes(stream, out, 1 << 16, False)
            finally:
                stream.close()
    finally:
        out.close()
