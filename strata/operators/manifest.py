"""Which hourly files are due, which have landed, and how an ingest run went."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row ``dt`` per day of an inclusive range."""
    one_row = spark.range(1).select(F.sequence(F.lit(start), F.lit(end)).alias("days"))
    return one_row.select(F.explode("days").alias("dt"))


def hour_manifest(due: DataFrame, prefix: str = "bronze", base_url: str | None = None) -> DataFrame:
    """One row per hour of each due day: source name, landing key and, given a base, the URL.

    The hour in the name is not padded: ``2024-01-01-7.json.gz``.
    """
    hours = due.select("dt", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))
    name = F.concat(
        F.date_format("dt", "yyyy-MM-dd"),
        F.lit("-"),
        F.col("hour_of_day").cast("string"),
        F.lit(".json.gz"),
    )
    folder = F.date_format("dt", "yyyy/MM/dd")
    columns = {
        "source_name": name,
        "landing_key": F.concat_ws("/", F.lit(prefix.rstrip("/")), folder, name),
    }
    if base_url:
        columns["source_url"] = F.concat_ws("/", F.lit(base_url.rstrip("/")), name)
    return hours.withColumns(columns)


def missing_hours(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Hours still to fetch: an hour with a landed file is skipped, so a rerun is idempotent."""
    return manifest.join(landed, "source_name", "left_anti")


def ingest_status(manifest: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Each hour as ``skipped`` (was there), ``ok`` (came, not empty) or ``failed``.

    ``before`` and ``after`` hold ``source_name, bytes`` of the landed files, one row each.
    """
    was = before.select("source_name", F.lit(True).alias("was_there"))
    now = after.select("source_name", "bytes")
    status = F.when(F.col("was_there"), "skipped").when(F.col("bytes") > 0, "ok")
    joined = manifest.join(was, "source_name", "left").join(now, "source_name", "left")
    return joined.select(
        *manifest.columns, F.coalesce("bytes", F.lit(0)).alias("bytes"),
        status.otherwise("failed").alias("status"),
    )


def ingest_summary(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("hours"))
