"""Landed hourly files: gzip JSON lines at ``YYYY/MM/DD/YYYY-MM-DD-H.json.gz``."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_glob(root: str, day: dt.date, name: str = "*.json.gz") -> str:
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}/{name}"


def hour_file(root: str, hour: dt.datetime) -> str:
    return f"{root.rstrip('/')}/{hour:%Y/%m/%d}/{hour:%Y-%m-%d}-{hour.hour}.json.gz"


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """``raw_json, source_file`` per line. A path or glob without files is an error."""
    try:
        lines = spark.read.text(list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no input files: {', '.join(paths)}") from error
        raise
    return lines.select(
        F.col("value").alias("raw_json"), F.col("_metadata.file_path").alias("source_file")
    )


def read_day(
    spark: SparkSession, root: str, day: dt.date, name: str = "*.json.gz"
) -> DataFrame:
    return read_lines(spark, day_glob(root, day, name))


def read_hour(spark: SparkSession, root: str, hour: dt.datetime) -> DataFrame:
    return read_lines(spark, hour_file(root, hour))


def read_days(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> DataFrame:
    """All days of an inclusive range as one scan; every day must have landed."""
    span = (end - start).days + 1
    return read_lines(spark, *(day_glob(root, start + dt.timedelta(n)) for n in range(span)))


def landed_files(
    spark: SparkSession, root: str, start: dt.date, end: dt.date, name: str = "*.json.gz"
) -> DataFrame:
    """``source_name, bytes`` of the files that landed for the days.

    Lists the days' own folders, without opening files. ``name`` is the glob of file names.
    """
    span = (end - start).days + 1
    folders = ",".join(f"{start + dt.timedelta(n):%Y/%m/%d}" for n in range(span))
    due = f"{root.rstrip('/')}/{{{folders}}}/{name}"
    try:
        files = spark.read.format("binaryFile").load(due)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "source_name string, bytes long")
    source = F.element_at(F.split("path", "/"), -1)
    return files.select(source.alias("source_name"), F.col("length").alias("bytes"))
