"""Event counts per repository, actor, day and type, and top-N of them.

Every function takes either events or a table of already counted events: ``weight`` is
then the column with the counts. Counting is additive, so both give the same result.
Each aggregate is combined on the map side, so a key that holds a third of all rows
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def event_count(weight: str | None = None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def counts_by(
    events: DataFrame, keys: Sequence[str], name: str, weight: str | None = None
) -> DataFrame:
    return events.groupBy(*keys).agg(event_count(weight).alias(name))


def repo_counts(events: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(events, ["repo_name"], "repo_event_count", weight)


def event_type_counts(events: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(events, ["event_type"], "event_count", weight)


def daily_repo_counts(events: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(events, ["dt", "repo_name"], "event_count", weight)


def with_actor(events: DataFrame) -> DataFrame:
    return events.where(F.col("actor_login").isNotNull())


def actor_counts(events: DataFrame, weight: str | None = None) -> DataFrame:
    return counts_by(with_actor(events), ["actor_login"], "actor_event_count", weight)


def actor_distinct_repo_counts(events: DataFrame) -> DataFrame:
    """Distinct repositories per actor; events without a repository do not count."""
    distinct = F.count_distinct("repo_name").alias("actor_repo_count")
    return with_actor(events).groupBy("actor_login").agg(distinct)


def largest(counts: DataFrame, metric: str, name: str, n: int | None = None) -> DataFrame:
    """Rows by metric descending, equal metrics by name; the first ``max(1, n)`` if ``n`` is given.

    Sort and limit together become a top-k per task, without a global sort.
    """
    ordered = counts.orderBy(F.desc(metric), F.asc(name))
    return ordered if n is None else ordered.limit(max(1, n))


def daily_largest(daily: DataFrame, metric: str, name: str, n: int) -> DataFrame:
    """The ``max(1, n)`` largest rows of each day with their ``daily_rank``.

    The rank filter limits each task to n rows per day before the shuffle, so one day's
    task receives n rows per map task whatever the day's size.
    """
    by_size = Window.partitionBy("dt").orderBy(F.desc(metric), F.asc(name))
    ranked = daily.withColumn("daily_rank", F.row_number().over(by_size))
    return ranked.where(F.col("daily_rank") <= max(1, n)).orderBy("dt", "daily_rank")


def join_top(events: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Events of the top-N names.

    Spark knows the limit of the list: a short one is sent to every executor, a long one is
    joined by sort-merge, with skewed partitions split at run time.
    """
    return events.join(top, key)


def event_type_breakdown(
    joined: DataFrame, key: str, metric: str, weight: str | None = None
) -> DataFrame:
    """Counts per (key, event type), each carrying the key's own metric; largest first."""
    counts = joined.groupBy(key, "event_type").agg(
        event_count(weight).alias("event_type_count"), F.max(metric).alias(metric)
    )
    return counts.orderBy(F.desc("event_type_count"), key, "event_type")
