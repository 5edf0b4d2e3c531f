"""Gold marts: Parquet or CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import versions

FORMATS = ("parquet", "csv")


def _save(df: DataFrame, path: str, fmt: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)


def write_mart(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    files: int = 0,
    partition_by: str | None = None,
) -> None:
    """Replace a mart; with ``partition_by``, only the partitions that ``df`` holds.

    A mart that is replaced whole is written as a new version and committed when it is
    complete: a run that fails leaves the mart that was there, and readers of the version
    before can finish. ``read_mart`` and ``mart_path`` lead to the newest version.

    ``files`` coalesces to that many, which also narrows the work before it: use it for
    marts of bounded size. Without it a partitioned mart is rebalanced on its partition
    column, so small days get one file each and large ones are split by size at run time;
    an ordered mart without partitions keeps the ranges of its sort, small ones as one file.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}: {fmt}")
    if files > 0:
        df = df.coalesce(files)
    elif partition_by:
        df = df.hint("rebalance", partition_by)
    if partition_by:
        _save(df, path, fmt, partition_by)
    else:
        versions.replace(df.sparkSession, path, lambda folder: _save(df, folder, fmt))


def mart_path(spark: SparkSession, path: str) -> str:
    """The folder of the files of a mart that is replaced whole."""
    return versions.latest_path(spark, path)


def read_mart(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """The newest version of a mart that is replaced whole; CSV needs its ``schema``."""
    reader = spark.read.schema(schema) if schema else spark.read
    folder = mart_path(spark, path)
    if fmt == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(folder)
    return reader.parquet(folder)
