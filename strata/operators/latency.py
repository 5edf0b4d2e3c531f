"""Review latency per repository and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import pr_windows
from strata.operators.pull_requests import (
    pull_request_base,
    review_comment_stats,
    review_stats,
    with_reviews,
)
from strata.session import materialize


def enriched_pull_requests(
    pr_events: DataFrame, reviews: DataFrame, comments: DataFrame
) -> DataFrame:
    return with_reviews(
        pull_request_base(pr_events), review_stats(reviews), review_comment_stats(comments)
    )


def windowed_pull_requests(
    pr_events: DataFrame,
    reviews: DataFrame,
    comments: DataFrame,
    slice_rows: int = pr_windows.SLICE_ROWS,
    wanted: Sequence[str] = tuple(pr_windows.WINDOWS),
) -> DataFrame:
    """Pull requests with the columns of all windows, or of those ``wanted``.

    Windows run within slices of at most about ``slice_rows`` pull requests. Where no
    repository is larger, its windows and the aggregate after them share one shuffle; else
    the rows are written first, as cuts and carried sums are read from them.
    """
    prs = enriched_pull_requests(pr_events, reviews, comments)
    if not pr_windows.has_large_repo(pr_events, slice_rows):
        return pr_windows.all_windows(prs, wanted)
    return pr_windows.sliced_windows(materialize(prs, "enriched"), slice_rows, wanted)


def review_latency(windowed: DataFrame) -> DataFrame:
    """The 18 measures per (opening day, repository), most pull requests first.

    A pull request is one row here, so the distinct count of ids is the row count. The
    percentile of a group of n is its value of rank ceil(p * n), what ``percentile_approx``
    gives while its sketch is exact. The rows carry that rank and n already, so this stays
    exact for any n, and no group needs a sketch.
    """

    def mean(column: str, name: str | None = None):
        return F.avg(column).alias(name or f"avg_{column}")

    def percentile(column: str, at: float, of: str):
        is_it = F.col("daily_review_speed_rank") == F.ceil(F.lit(at) * F.col(of))
        return F.max(F.when(is_it, F.col(column))).alias(f"p{at * 100:.0f}_{column}")

    measures = windowed.groupBy("dt", "repo_name").agg(
        F.count("pull_request_id").alias("pr_count"),
        F.sum("reviewed_pr").alias("reviewed_pr_count"),
        mean("first_review_hours"),
        percentile("first_review_hours", 0.9, of="day_reviewed_pr_count"),
        percentile("first_review_hours", 0.95, of="day_reviewed_pr_count"),
        mean("first_review_comment_hours"),
        mean("review_count"),
        mean("review_comment_count"),
        F.sum("review_comment_count").alias("total_review_comment_count"),
        F.sum("approval_count").alias("total_approval_count"),
        mean("repo_review_speed_rank"),
        percentile("repo_review_speed_rank", 0.9, of="day_pr_count"),
        mean("repo_review_speed_percent_rank"),
        mean("daily_review_speed_rank"),
        mean("pr_gap_hours"),
        mean("rolling_pr_count_50"),
        F.max("rolling_pr_count_50").alias("max_rolling_pr_count_50"),
        mean("rolling_avg_first_review_hours_50", "avg_rolling_first_review_hours_50"),
    )
    return measures.orderBy(F.desc("pr_count"), "dt", "repo_name")
