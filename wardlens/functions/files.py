"""Small files of the shared folder, through Hadoop's file system, so any store that Spark writes to works."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def file_names(spark: SparkSession, folder: str) -> Sequence[str]:
    """Names of the files and folders in a folder that holds few."""
    return sorted(s.getPath().getName() for s in _system(spark, folder).listStatus(_path(spark, folder)))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or none if it is not there."""
    if not exists(spark, path):
        return None
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str, attempt: str) -> bool:
    """Make a small file appear whole under its name, unless one is already there; false if so.

    It is written next to its place and renamed, which is one step on a file system and on HDFS.
    """
    system, aside = _system(spark, path), f"{path}.{attempt}"
    stream = system.create(_path(spark, aside), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not system.exists(_path(spark, path)) and system.rename(_path(spark, aside), _path(spark, path)):
        return True
    system.delete(_path(spark, aside), False)
    return False


def remove(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).delete(_path(spark, path), True)


def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha256, size) of every readable data file under a folder, hashed by the executors."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true")
    files = read.load(folder)
    root = _system(spark, folder).makeQualified(_path(spark, folder)).toString()
    inside = F.substring_index(F.col("path"), root.rsplit("/", 1)[-1] + "/", -1)
    return files.select(inside.alias("file"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def folder_digest(spark: SparkSession, folder: str) -> dict[str, str]:
    """Digest per file of a folder of a few files, such as a stored model or report."""
    return {r["file"]: r["sha256"] for r in file_digests(spark, folder).collect()}


def damaged_files(known: dict[str, str], found: dict[str, str]) -> Sequence[str]:
    return sorted(f for f in known.keys() | found.keys() if known.get(f) != found.get(f))
