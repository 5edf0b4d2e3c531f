"""Pushes per branch group and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import branch_group


def branch_counts(pushes: DataFrame) -> DataFrame:
    grouped = pushes.select("dt", branch_group("ref").alias("branch_group"))
    return grouped.groupBy("dt", "branch_group").agg(F.count(F.lit(1)).alias("push_count"))


def with_daily_share(counts: DataFrame) -> DataFrame:
    """Add the day's total and each group's share of it.

    A day has four branch groups at most, so the window is over four rows; it replaces a
    second aggregate joined back on the day.
    """
    total = F.sum("push_count").over(Window.partitionBy("dt"))
    return counts.withColumn("total_push_count", total).withColumn(
        "branch_ratio", F.col("push_count") / F.col("total_push_count")
    )
