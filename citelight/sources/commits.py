"""Commits: numbered small files, the newest of which says what a table or a warehouse consists of.

Data is first written to folders that nobody reads. A commit then names the folders that count, as JSON in one
file, written under another name and renamed to the next number. A rename to a number that exists fails, so of
two writers that started from the same commit one is told. A job that dies before its commit leaves everything as it was;
its folders are never read.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Commits kept besides the newest.
KEPT = 5


class Conflict(RuntimeError):
    """Another writer has committed since this one began."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path."""
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in file_system(spark, path).listStatus(_path(spark, path)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder."""
    file_system(spark, path).delete(_path(spark, path), True)


def newest(spark: SparkSession, folder: str) -> tuple[int, dict]:
    """Number and content of the newest commit; 0 and nothing if there is none."""
    numbers = [int(name) for name in children(spark, folder) if name.isdigit()]
    if not numbers:
        return 0, {}
    number = max(numbers)
    place = f"{folder}/{number:08d}"
    stream = file_system(spark, place).open(_path(spark, place))
    try:
        return number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, number: int, content: dict) -> None:
    """Make ``content`` commit ``number``; :class:`Conflict` if that number is taken."""
    system = file_system(spark, folder)
    system.mkdirs(_path(spark, folder))
    place, draft = f"{folder}/{number:08d}", f"{folder}/_{uuid.uuid4().hex}"
    out = system.create(_path(spark, draft), False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.makeQualified(_path(spark, folder)).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, draft), _path(spark, place), options)
    except Py4JJavaError as error:
        remove(spark, draft)
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            raise Conflict(f"commit {number} of {folder} exists") from error
        raise
    for name in children(spark, folder):
        if name.isdigit() and int(name) < number - KEPT:
            remove(spark, f"{folder}/{name}")
