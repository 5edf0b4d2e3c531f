"""What the operators share: unique row keys, text expressions, files reached from tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import strata
from strata.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(rows: DataFrame, id_column: str, *columns: str) -> DataFrame:
    """The id and the named columns, with ``_key``: a unique, non-null long in the order of ids.

    Ids that are unique and not null are the keys themselves. Otherwise every row is a
    document of its own: rows are numbered by (id, the other columns), null first, and the
    numbering is written once, so that a lost executor cannot change it.
    """
    slim = rows.select(id_column, *columns)
    odd = slim.groupBy(id_column).count().where(F.col(id_column).isNull() | (F.col("count") > 1))
    if odd.isEmpty():
        return slim.withColumn("_key", F.col(id_column).cast("long"))
    ordered = slim.orderBy(id_column, *columns).withColumn("_key", F.monotonically_increasing_id())
    return materialize(ordered, "keyed")


def keyed_whole(rows: DataFrame, id_column: str, *columns: str) -> DataFrame:
    """(_key, _row, named columns): the keys of ``keyed``, with whole rows as structs.

    Filters that judge by ``_key`` give back ``_row.*``: each row by its own judgement, also
    where ids are null or repeated.
    """
    slim = rows.select(F.struct(*(rows[name] for name in rows.columns)).alias("_row"), id_column, *columns)
    odd = slim.groupBy(id_column).count().where(F.col(id_column).isNull() | (F.col("count") > 1))
    if odd.isEmpty():
        return slim.select(F.col(id_column).cast("long").alias("_key"), "_row", *columns)
    ordered = slim.orderBy(id_column, *columns).withColumn("_key", F.monotonically_increasing_id())
    return materialize(ordered.select("_key", "_row", *columns), "keyed")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def whole(text: str | Column) -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(strata.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="strata-package-")) / "strata-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
