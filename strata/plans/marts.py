"""The eight gold marts, each stamped with the days it covers.

``weight`` names the count column when ``events`` is a table of already counted events.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import date_range_stamp
from strata.operators import counts, latency, pr_windows, pushes

# The metric column of each way to rank actors.
ACTOR_METRICS = {"event_count": "actor_event_count", "distinct_repo": "actor_repo_count"}


@dataclass(frozen=True)
class Days:
    """The inclusive day range that a mart covers."""

    start: dt.date
    end: dt.date

    def stamp(self, df: DataFrame) -> DataFrame:
        return df.withColumns(date_range_stamp(self.start, self.end))


def resolve_days(
    date: dt.date | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    today: dt.date | None = None,
) -> Days:
    """One date, or a start with an optional end; neither means yesterday (UTC)."""
    if date and start:
        raise ValueError("give a date or a start, not both")
    if date:
        return Days(date, date)
    if start:
        return Days(start, end or start)
    if end:
        raise ValueError("an end needs a start")
    today = today or dt.datetime.now(dt.timezone.utc).date()
    yesterday = today - dt.timedelta(days=1)
    return Days(yesterday, yesterday)


def top_repos(events: DataFrame, days: Days, n: int = 10, weight: str | None = None) -> DataFrame:
    repos = counts.repo_counts(events, weight)
    return days.stamp(counts.largest(repos, "repo_event_count", "repo_name", max(1, n)))


def top_event_types(
    events: DataFrame, days: Days, n: int = 20, weight: str | None = None
) -> DataFrame:
    types = counts.event_type_counts(events, weight)
    return days.stamp(counts.largest(types, "event_count", "event_type", max(1, n)))


def repo_dim(top: DataFrame) -> DataFrame:
    return top.select("repo_name", "repo_event_count")


def top_repo_event_types(
    events: DataFrame, top: DataFrame, days: Days, n: int = 10, weight: str | None = None
) -> DataFrame:
    """Event types of the top repositories. Events without a repository match none."""
    joined = counts.join_top(events, repo_dim(top), "repo_name")
    return days.stamp(
        counts.event_type_breakdown(joined, "repo_name", "repo_event_count", weight)
    )


def top_actors(
    events: DataFrame,
    days: Days,
    n: int = 10,
    metric: str = "event_count",
    weight: str | None = None,
) -> DataFrame:
    """Top actors by events or by distinct repositories (the latter needs the events)."""
    column = ACTOR_METRICS[metric]
    if metric == "distinct_repo":
        actors = counts.actor_distinct_repo_counts(events)
    else:
        actors = counts.actor_counts(events, weight)
    return days.stamp(counts.largest(actors, column, "actor_login", max(1, n)))


def actor_dim(top: DataFrame, metric: str = "event_count") -> DataFrame:
    return top.select("actor_login", F.col(ACTOR_METRICS[metric]))


def top_actor_event_types(
    events: DataFrame,
    top: DataFrame,
    days: Days,
    n: int = 10,
    metric: str = "event_count",
    weight: str | None = None,
) -> DataFrame:
    joined = counts.join_top(events, actor_dim(top, metric), "actor_login")
    return days.stamp(
        counts.event_type_breakdown(joined, "actor_login", ACTOR_METRICS[metric], weight)
    )


def daily_top_repos(
    events: DataFrame, days: Days, n: int = 10, weight: str | None = None
) -> DataFrame | None:
    """The day's top repositories; ``n`` of 0 or less switches the mart off."""
    if n <= 0:
        return None
    daily = counts.daily_repo_counts(events, weight)
    return days.stamp(counts.daily_largest(daily, "event_count", "repo_name", n))


def push_branch_ratio(push_events: DataFrame, days: Days) -> DataFrame:
    return days.stamp(pushes.with_daily_share(pushes.branch_counts(push_events)))


def pull_request_review_latency(
    pr_events: DataFrame,
    reviews: DataFrame,
    comments: DataFrame,
    days: Days,
    slice_rows: int = pr_windows.SLICE_ROWS,
) -> DataFrame:
    windowed = latency.windowed_pull_requests(pr_events, reviews, comments, slice_rows)
    return days.stamp(latency.review_latency(windowed))
