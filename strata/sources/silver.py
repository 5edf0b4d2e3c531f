"""Silver tables: Parquet partitioned by ``dt`` at ``{root}/{dataset}``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import in_days
from strata.functions.schemas import EVENTS_BASE
from strata.operators.manifest import days
from strata.operators.tracks import TRACKS, track
from strata.sources import folders

BASE = "events_base"

# The columns that the marts read from each dataset.
MART_COLUMNS = {
    BASE: ["dt", "repo_name", "actor_login", "event_type", "event_id"],
    "events_push": ["dt", "repo_name", "ref"],
    "events_pull_request": [
        "dt",
        "repo_name",
        "created_at_ts",
        "action",
        "pull_request_id",
        "pull_request_number",
        "pull_request_merged",
        "pull_request_merged_at",
        "commit_count",
        "additions",
        "deletions",
        "changed_files",
    ],
    "events_pull_request_review": [
        "dt",
        "repo_name",
        "pull_request_id",
        "review_id",
        "review_state",
        "review_submitted_at",
    ],
    "events_pull_request_review_comment": [
        "dt",
        "repo_name",
        "pull_request_id",
        "comment_id",
        "comment_created_at",
    ],
}


def table_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


_schemas: dict[str, T.StructType] = {BASE: EVENTS_BASE}


def table_schema(spark: SparkSession, dataset: str) -> T.StructType:
    """The declared schema: a table that holds no file yet still reads, as zero rows."""
    if dataset not in _schemas:
        if dataset not in TRACKS:
            raise KeyError(f"no such silver dataset: {dataset}")
        _schemas[dataset] = track(spark.createDataFrame([], EVENTS_BASE), dataset).schema
    return _schemas[dataset]


def read_table(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    schema = table_schema(spark, dataset)
    return spark.read.schema(schema).parquet(table_path(root, dataset))


def read_days(
    spark: SparkSession, root: str, dataset: str, start: dt.date, end: dt.date
) -> DataFrame:
    """An inclusive day range of a dataset, from the folders of those days alone.

    One listing of the dataset's folder tells which days there are; the files of other days
    are never listed. A dataset never written is an error, days without a folder are not.
    """
    path, schema = table_path(root, dataset), table_schema(spark, dataset)
    folders_found = [f"{path}/{name}" for _, name in day_folders(spark, root, dataset, start, end)]
    if folders_found:
        found = spark.read.schema(schema).option("basePath", path).parquet(*folders_found)
        return found.where(in_days(start, end))
    # As a scan has it: the partition column comes last.
    own = [field for field in schema.fields if field.name != "dt"]
    return spark.createDataFrame([], T.StructType([*own, schema["dt"]]))


def day_folders(
    spark: SparkSession, root: str, dataset: str, start: dt.date, end: dt.date
) -> list[tuple[dt.date, str]]:
    """The days of the range that have a folder, with its name."""
    path = table_path(root, dataset)
    names = folders.names(spark, path)
    if not names and not folders.exists(spark, path):
        read_table(spark, root, dataset)  # reports the missing path as Spark does
    dated = ((_folder_day(name), name) for name in names)
    return sorted((day, name) for day, name in dated if day and start <= day <= end)


def _folder_day(name: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(name.removeprefix("dt=")) if name.startswith("dt=") else None
    except ValueError:
        return None


def read_for_marts(
    spark: SparkSession, root: str, dataset: str, start: dt.date, end: dt.date
) -> DataFrame:
    return read_days(spark, root, dataset, start, end).select(*MART_COLUMNS[dataset])


def read_day_or_empty(spark: SparkSession, root: str, dataset: str, day: dt.date) -> DataFrame:
    """One day of a dataset, and zero rows of it where the dataset has never been written."""
    try:
        return read_days(spark, root, dataset, day, day)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table_schema(spark, dataset))


def write_days(
    df: DataFrame,
    root: str,
    dataset: str,
    repartition: int = 0,
    coalesce: int = 0,
    rebalance: bool = False,
    row_group_bytes: int | None = None,
) -> None:
    """Replace the days that ``df`` holds; other days of the dataset stay.

    The number of files can be set by ``repartition`` or ``coalesce``. ``rebalance`` leaves
    it to the size of the data: small days become one file each, large ones are split.
    Rows sorted by a filter column are skipped the better the smaller the row groups.

    A frame without rows replaces nothing, so a rerun that finds no rows for a day leaves
    the day's old rows in place: compare with ``audit_days``.
    """
    if repartition > 0 and coalesce > 0:
        raise ValueError("repartition and coalesce exclude each other")
    if repartition > 0:
        df = df.repartition(repartition)
    elif coalesce > 0:
        df = df.coalesce(coalesce)
    elif rebalance:
        df = df.hint("rebalance", "dt")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.partitionBy("dt").parquet(table_path(root, dataset))


def audit_tables(
    spark: SparkSession, root: str, datasets: Sequence[str], start: dt.date, end: dt.date
) -> DataFrame:
    """Files, bytes and rows of each dataset and day, ``missing`` where there is no partition.

    One scan over the range's folders of all datasets; it reads no column, so of every file
    only the footer, which tells its rows. A dataset never written is an error.
    """
    paths = [
        f"{table_path(root, name)}/{folder}"
        for name in datasets
        for _, folder in day_folders(spark, root, name, start, end)
    ]
    scanned = spark.read.schema("event_id string").option("recursiveFileLookup", True)
    if paths:
        own = scanned.parquet(*paths).select("_metadata.file_path", "_metadata.file_size")
    else:
        own = spark.createDataFrame([], "file_path string, file_size long")
    parts = F.split("file_path", "/")
    files = own.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows"))
    found = files.groupBy(
        F.element_at(parts, -3).alias("dataset"),
        F.to_date(F.substring_index(F.element_at(parts, -2), "=", -1)).alias("dt"),
    ).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"),
        F.sum("rows").alias("rows"),
    )
    due = days(spark, start, end).select("dt", F.explode(F.array(*map(F.lit, datasets))).alias("dataset"))
    joined = due.join(found, ["dt", "dataset"], "left")
    return joined.withColumn("missing", F.col("files").isNull()).fillna(
        0, ["files", "bytes", "rows"]
    )


def audit_days(
    spark: SparkSession, root: str, dataset: str, start: dt.date, end: dt.date
) -> DataFrame:
    """``audit_tables`` of one dataset."""
    return audit_tables(spark, root, [dataset], start, end).drop("dataset")
