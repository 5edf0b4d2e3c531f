"""Drift metadata: the registry of known variants, results per day, and the history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.schemas import DATE, STRING, TIMESTAMP, record
from strata.session import materialize
from strata.sources import versions

REGISTRY = record(
    track=STRING, payload_variant=STRING, first_seen_dt=DATE, last_updated=TIMESTAMP
)
HISTORY = record(
    recorded_at=TIMESTAMP,
    dt=DATE,
    drift_detected=T.BooleanType(),
    total_new_variants=T.LongType(),
    max_failure_rate=T.DoubleType(),
    affected_tracks=T.ArrayType(STRING),
)


def _registry_root(root: str) -> str:
    return f"{root.rstrip('/')}/variant_registry"


def _history_root(root: str) -> str:
    return f"{root.rstrip('/')}/drift_history"


def registry_version(spark: SparkSession, root: str) -> int:
    """The latest snapshot's number, from the names of the commits: no snapshot is read."""
    return versions.latest(spark, _registry_root(root))


def read_registry(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The latest snapshot of the known variants, and its version; empty before the first."""
    return versions.read(spark, _registry_root(root), REGISTRY)


def _stamped(registry: DataFrame) -> DataFrame:
    return registry.withColumn("last_updated", F.current_timestamp()).select(*REGISTRY.fieldNames())


def write_registry(registry: DataFrame, root: str, version: int) -> None:
    """Commit a snapshot as ``version``, which must follow the one it was made from.

    Raises ``VersionTaken`` where another run has committed that version. The last few
    snapshots stay, so the table being merged is never overwritten.
    """
    save = _stamped(registry).write.parquet
    versions.write(registry.sparkSession, _registry_root(root), version, save)


def update_registry(
    spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame]
) -> int:
    """Commit ``merge`` of the latest snapshot where it adds to it; the version that holds.

    Where another run commits first, its snapshot is merged into again: no variant is lost.
    """

    def change(known: DataFrame) -> DataFrame | None:
        merged = materialize(merge(known), "registry")
        old = known.select(merged.columns)
        return None if merged.exceptAll(old).isEmpty() else _stamped(merged)

    return versions.update(spark, _registry_root(root), REGISTRY, change)


def write_results(daily: DataFrame, verdicts: DataFrame, variants: DataFrame, root: str) -> None:
    """The day's roll-up with its track rows as one JSON document, its variants as JSON lines.

    A rerun replaces the day. The nested list is as long as the list of checked tracks.
    """
    tracks = verdicts.groupBy("dt").agg(
        F.array_sort(F.collect_list(F.struct(*(c for c in verdicts.columns if c != "dt")))).alias(
            "track_results"
        )
    )
    document = daily.join(tracks, "dt").withColumn("written_at", F.current_timestamp())
    for name, frame, files in (
        ("drift_results", document, 1),
        ("drift_variants", variants, 0),
    ):
        frame = frame.withColumnRenamed("dt", "target_date")
        frame = frame.coalesce(files) if files else frame
        (
            frame.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("target_date")
            .json(f"{root.rstrip('/')}/{name}")
        )


def read_verdicts(
    spark: SparkSession, root: str, day: dt.date, schema: T.StructType
) -> DataFrame:
    """The stored track rows of a day; ``schema`` is that of the verdicts."""
    stored = T.ArrayType(T.StructType([f for f in schema.fields if f.name != "dt"]))
    document = T.StructType(
        [T.StructField("track_results", stored), T.StructField("target_date", T.DateType())]
    )
    documents = spark.read.schema(document).json(f"{root.rstrip('/')}/drift_results")
    own = documents.where(F.col("target_date") == F.lit(day))
    rows = own.select(F.col("target_date").alias("dt"), F.explode("track_results").alias("r"))
    return rows.select(*("dt" if n == "dt" else f"r.{n}" for n in schema.fieldNames()))


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All runs; one file, however many there were."""
    return versions.read(spark, _history_root(root), HISTORY)[0]


def append_history(daily: DataFrame, root: str) -> None:
    """Record a run. Readers take the last 100 (``drift_history``).

    The history is a row for each run, rewritten as one file by each: some hundred kilobytes
    after years of daily runs. Of runs at the same time each is recorded.
    """
    event = daily.withColumn("recorded_at", F.current_timestamp()).select(*HISTORY.fieldNames())
    versions.update(daily.sparkSession, _history_root(root), HISTORY, lambda past: past.unionByName(event))
