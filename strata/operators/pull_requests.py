"""One row per pull request, with its review activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import event_time, hours_between

PULL_REQUEST_KEY = ["repo_name", "pull_request_id"]


def pull_request_base(events: DataFrame) -> DataFrame:
    """First opening, last merge and largest size of each pull request.

    Pull requests that are never seen opening are left out. ``dt`` is the opening day.
    """
    known = events.where(F.col("pull_request_id").isNotNull())
    opened = F.when(F.col("action") == "opened", F.col("created_at_ts"))
    largest = ["pull_request_merged", "commit_count", "additions", "deletions", "changed_files"]
    base = known.groupBy(PULL_REQUEST_KEY).agg(
        F.min(opened).alias("opened_at"),
        F.max(event_time("pull_request_merged_at")).alias("merged_at"),
        *(F.max(column).alias(column) for column in largest),
    )
    return base.where("opened_at IS NOT NULL").withColumn("dt", F.to_date("opened_at"))


def _by_pull_request(rows: DataFrame) -> DataFrame:
    """Dealt by pull request: a distinct count then needs one exchange in place of two.

    Ids are nearly unique, so combining them before the exchange would save little. Callers
    parse their texts before it: a time is shorter than its text.
    """
    return rows.repartition(*PULL_REQUEST_KEY)


def review_stats(reviews: DataFrame) -> DataFrame:
    """First review, distinct reviews and approving rows of each pull request."""
    known = reviews.dropna(subset=["pull_request_id", "review_id"]).select(
        *PULL_REQUEST_KEY,
        "review_id",
        event_time("review_submitted_at").alias("at"),
        (F.col("review_state") == "approved").alias("approves"),
    )
    return _by_pull_request(known).groupBy(PULL_REQUEST_KEY).agg(
        F.min("at").alias("first_review_at"),
        F.count_distinct("review_id").alias("review_count"),
        F.count_if("approves").alias("approval_count"),
    )


def review_comment_stats(comments: DataFrame) -> DataFrame:
    """First review comment and distinct review comments of each pull request."""
    known = comments.dropna(subset=["pull_request_id", "comment_id"]).select(
        *PULL_REQUEST_KEY, "comment_id", event_time("comment_created_at").alias("at")
    )
    return _by_pull_request(known).groupBy(PULL_REQUEST_KEY).agg(
        F.min("at").alias("first_review_comment_at"),
        F.count_distinct("comment_id").alias("review_comment_count"),
    )


def with_reviews(base: DataFrame, reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """Pull requests with their review and comment stats, zero-filled, and hours to the first.

    All three sides are aggregated on the join key, hence unique and already partitioned
    by it: the joins add no shuffle. A pull request without a repository matches nothing.
    """
    joined = base.join(reviews, PULL_REQUEST_KEY, "left").join(comments, PULL_REQUEST_KEY, "left")
    filled = joined.fillna(0, ["review_count", "approval_count", "review_comment_count"])
    return filled.withColumns(
        {
            "first_review_hours": hours_between("opened_at", "first_review_at"),
            "first_review_comment_hours": hours_between("opened_at", "first_review_comment_at"),
            "reviewed_pr": F.col("first_review_at").isNotNull().cast("int"),
        }
    )
