"""What lies at a location, on whatever file system the cluster uses."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    files, path = _at(spark, location)
    return files.exists(path)


def children(spark: SparkSession, location: str) -> list[str]:
    files, path = _at(spark, location)
    return [status.getPath().getName() for status in files.listStatus(path)]


def folder_bytes(spark: SparkSession, location: str) -> int:
    files, path = _at(spark, location)
    return files.getContentSummary(path).getLength()


def read_text(spark: SparkSession, location: str) -> str:
    files, path = _at(spark, location)
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, location: str, text: str) -> bool:
    """Write a new file; False, and nothing written, where there is one already."""
    files, path = _at(spark, location)
    try:
        stream = files.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or files.exists(path):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def delete_folder(spark: SparkSession, location: str) -> None:
    files, path = _at(spark, location)
    files.delete(path, True)


def hours_old(spark: SparkSession, location: str) -> float:
    """Hours since the location was last changed."""
    files, path = _at(spark, location)
    return max(0.0, time.time() - files.getFileStatus(path).getModificationTime() / 1000) / 3600
