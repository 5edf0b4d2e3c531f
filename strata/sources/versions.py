"""Small tables that are replaced whole: each write is a new version, committed in one step.

A version's files go to a folder of their own under ``data``; then a commit file named after
the version's number is created, which fails where that number is taken. Readers follow the
highest commit, so they see the old version until the new one is complete: a lost writer
leaves files that nobody refers to, never half a table. Of two writers that started from the
same version one gets ``VersionTaken`` and has to start again from the other's result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources import folders

#: Versions that stay: a reader that has just looked up the one before can still read it.
KEPT = 5
#: Attempts of ``update`` before it gives up.
ATTEMPTS = 8
# Fixed value: the version of a table that has never been written.
NONE = 1


class VersionTaken(RuntimeError):
    """Another writer has committed that version."""


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def _commit(root: str, version: int) -> str:
    return f"{_commits(root)}/{version:020d}"


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, in order, from one listing of the commit folder."""
    return sorted(int(name) for name in folders.names(spark, _commits(root)) if name.isdigit())


def latest(spark: SparkSession, root: str) -> int:
    return max(versions(spark, root), default=NONE)


def version_path(spark: SparkSession, root: str, version: int) -> str:
    """The folder that holds a version's files."""
    return f"{root.rstrip('/')}/data/{folders.read_text(spark, _commit(root, version))}"


def latest_path(spark: SparkSession, root: str) -> str:
    """The folder of the newest version; an error where there is none."""
    version = latest(spark, root)
    if version == NONE:
        raise FileNotFoundError(f"no version of {root}")
    return version_path(spark, root, version)


def read(spark: SparkSession, root: str, schema: T.StructType) -> tuple[DataFrame, int]:
    """The newest version and its number; zero rows and ``NONE`` before the first."""
    version = latest(spark, root)
    if version == NONE:
        return spark.createDataFrame([], schema), version
    return spark.read.schema(schema).parquet(version_path(spark, root, version)), version


def write(
    spark: SparkSession,
    root: str,
    version: int,
    save: Callable[[str], None],
    keep: int = KEPT,
) -> None:
    """Commit what ``save`` writes to the folder it is given as ``version``.

    Raises ``VersionTaken`` where the version exists, before ``save`` runs or after it. Of
    older versions ``keep`` stay.
    """
    if version in versions(spark, root):
        raise VersionTaken(f"version {version} of {root}")
    name = f"v{version}-{uuid.uuid4().hex}"
    folder = f"{root.rstrip('/')}/data/{name}"
    save(folder)
    if not folders.create_text(spark, _commit(root, version), name):
        folders.delete(spark, folder)
        raise VersionTaken(f"version {version} of {root}")
    thin(spark, root, keep)


def replace(
    spark: SparkSession, root: str, save: Callable[[str], None], keep: int = KEPT
) -> int:
    """Commit what ``save`` writes as the newest version, whichever it follows."""
    name = uuid.uuid4().hex
    folder = f"{root.rstrip('/')}/data/{name}"
    save(folder)
    version = latest(spark, root) + 1
    while not folders.create_text(spark, _commit(root, version), name):
        version += 1
    thin(spark, root, keep)
    return version


def thin(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Drop all but the newest ``keep`` versions. The commit goes first, so that no reader
    is led to files that are gone. Numbers are never used again: the newest always stays."""
    for version in versions(spark, root)[: -max(keep, 1)]:
        path = version_path(spark, root, version)
        folders.delete(spark, _commit(root, version))
        folders.delete(spark, path)


def update(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    change: Callable[[DataFrame], DataFrame | None],
    keep: int = KEPT,
) -> int:
    """Commit ``change`` of the newest version, again from the start where another was first.

    ``change`` gets the rows and returns the new ones, or None to leave the table as it is.
    Returns the number of the version that then holds.
    """
    for _ in range(ATTEMPTS):
        rows, version = read(spark, root, schema)
        try:
            changed = change(rows)
            if changed is None:
                return version
            # The version it reads from is one of those that stay.
            changed = changed.select(*schema.fieldNames()).coalesce(1)
            write(spark, root, version + 1, changed.write.parquet, keep)
            return version + 1
        except VersionTaken:
            continue
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND" or latest(spark, root) == version:
                raise
    raise VersionTaken(f"{root}: {ATTEMPTS} attempts")
