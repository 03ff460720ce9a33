"""Small text files in the store that holds the reports, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _path(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _path(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing where there is none."""
    at, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _path(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that is there as a whole or not at all; False if there is one already.

    It is written under another name beside it and renamed without overwriting, so of two writers
    one is told that the other was first.
    """
    at, fs = _path(spark, path)
    if fs.exists(at):
        return False
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    other, _ = _path(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    stream = fs.create(other, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(other, at, gateway.new_array(rename, 0))
    except (PySparkException, gateway_error()) as error:
        fs.delete(other, False)
        if fs.exists(at):
            return False
        raise error
    return True


def gateway_error() -> type[Exception]:
    from py4j.protocol import Py4JJavaError

    return Py4JJavaError
