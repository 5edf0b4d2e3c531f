"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizing stays with the deployment."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="strata-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return _local_folder()


_scope: ContextVar[str | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of its own under the shared folder, or under the job's scratch folder."""
    parent = _scope.get() or f"{shared_folder(spark)}/strata"
    return f"{parent}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[None]:
    """A scratch folder for a job: what is materialised inside goes there and is removed at
    the end, so results must have been written elsewhere by then."""
    folder = scratch_path(spark, name)
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def require_utc(spark: SparkSession) -> None:
    """Days are UTC days: a session of another zone would put events into other partitions."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC; it is {zone}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: the rows are computed once, any later loss of an executor re-reads
    them, and columns and filters of later uses are pushed into the Parquet scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_together(writes: Iterable[Callable[[], None]], at_once: int = 4) -> None:
    """Run independent writes side by side, so that the tail of one does not idle the cluster.

    Waits for all of them; the first failure is raised.
    """
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(copy_context().run, write) for write in writes]:
            done.result()
