"""Row profiles of silver tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.counts import counts_by, largest

PREVIEW_ROWS = 20


def type_profile(base: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The most frequent event types."""
    return largest(counts_by(base, ["event_type"], "count"), "count", "event_type", rows)


def track_profile(track: DataFrame) -> DataFrame:
    """Rows and rows with a readable payload."""
    return track.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("payload_parse_ok").alias("payload_ok")
    )


def track_profiles(observed: DataFrame, names: Iterable[str]) -> DataFrame:
    """``track_profile`` of many tracks from their observed payloads; 0 for those without rows."""
    found = observed.groupBy("track").agg(
        F.sum("times").alias("rows"),
        F.sum(F.when(F.col("payload_parse_ok"), F.col("times")).otherwise(0)).alias("payload_ok"),
    )
    every = observed.sparkSession.createDataFrame([(name,) for name in names], "track string")
    return every.join(found, "track", "left").fillna(0, ["rows", "payload_ok"])


def preview(
    table: DataFrame, columns: list[str], order: list[str], rows: int = PREVIEW_ROWS
) -> DataFrame:
    """The first rows by ``order``: a rerun shows the same ones."""
    return table.select(*columns).orderBy(*order).limit(rows)
