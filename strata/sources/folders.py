"""Folders and small files in whatever store a path names, through Hadoop's file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()), own


def exists(spark: SparkSession, path: str) -> bool:
    store, own = _at(spark, path)
    return store.exists(own)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names right in a folder, by one listing; none where it does not exist."""
    store, own = _at(spark, path)
    try:
        return [status.getPath().getName() for status in store.listStatus(own)]
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileNotFoundException":
            raise
        return []


def delete(spark: SparkSession, path: str) -> None:
    store, own = _at(spark, path)
    store.delete(own, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    store, own = _at(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    store.mkdirs(new.getParent())
    if not store.rename(own, new):
        raise OSError(f"cannot rename {path} to {target}")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with the text; False where there is one already.

    The file is written aside and renamed, so it is never seen half written. On HDFS the
    rename itself refuses a taken name; other stores look first, so that of two writers
    within the same instant the later may win there.
    """
    store, aside = _at(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    _, own = _at(spark, path)
    out = store.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        own.toUri(), spark._jsc.hadoopConfiguration()
    )
    how = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(store.makeQualified(aside), store.makeQualified(own), spark.sparkContext._gateway.new_array(how, 0))
    except Py4JJavaError as error:
        store.delete(aside, False)
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    store, own = _at(spark, path)
    stream = store.open(own)
    try:
        data = bytearray()
        while (byte := stream.read()) >= 0:
            data.append(byte)
        return data.decode()
    finally:
        stream.close()
