"""Counts, top-N, breakdowns, branch ratios, and the rows of a pull request."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import branch_group
from strata.operators import counts, latency, pull_requests
from strata.plans import marts
from strata.plans.marts import Days, resolve_days

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
DAYS = Days(D1, D2)


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        (D1, "b", "ann", "Push"),
        (D1, "b", "ann", "Watch"),
        (D1, "a", "bob", "Push"),
        (D1, "a", None, "Push"),
        (D2, None, "bob", "Push"),
        (D2, None, "bob", "Fork"),
        (D2, None, "ann", "Push"),
        (D2, "c", "bob", "Push"),
    ]
    return spark.createDataFrame(
        rows, "dt date, repo_name string, actor_login string, event_type string"
    )


def tuples(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_top_repos_counts_null_and_breaks_ties_by_name(events):
    got = tuples(marts.top_repos(events, DAYS))
    assert got == [(None, 3, D1, D2), ("a", 2, D1, D2), ("b", 2, D1, D2), ("c", 1, D1, D2)]
    assert len(tuples(marts.top_repos(events, DAYS, n=2))) == 2
    assert len(tuples(marts.top_repos(events, DAYS, n=0))) == 1  # floored at one


def test_breakdown_drops_events_without_a_repository(events):
    top = marts.top_repos(events, DAYS, n=3)
    got = tuples(
        marts.top_repo_event_types(events, top, DAYS, n=3),
        "repo_name", "event_type", "event_type_count", "repo_event_count",
    )
    assert got == [("a", "Push", 2, 2), ("b", "Push", 1, 2), ("b", "Watch", 1, 2)]


def test_lists_are_joined_without_a_hint(events):
    joined = counts.join_top(events, marts.top_repos(events, DAYS, n=3), "repo_name")
    assert "broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_actors_by_events_or_by_distinct_repositories(events):
    assert tuples(marts.top_actors(events, DAYS), "actor_login", "actor_event_count") == [
        ("bob", 4), ("ann", 3),
    ]
    by_repo = marts.top_actors(events, DAYS, metric="distinct_repo")
    assert tuples(by_repo, "actor_login", "actor_repo_count") == [("bob", 2), ("ann", 1)]
    types = marts.top_actor_event_types(events, by_repo, DAYS, metric="distinct_repo")
    assert tuples(types, "actor_login", "event_type", "event_type_count", "actor_repo_count") == [
        ("bob", "Push", 3, 2), ("ann", "Push", 2, 1), ("ann", "Watch", 1, 1), ("bob", "Fork", 1, 2),
    ]


def test_daily_top_repos(events):
    got = marts.daily_top_repos(events, DAYS, n=1)
    assert tuples(got, "dt", "repo_name", "event_count", "daily_rank") == [
        (D1, "a", 2, 1), (D2, None, 3, 1),
    ]
    assert marts.daily_top_repos(events, DAYS, n=0) is None


def test_counted_events_give_the_same_marts(events):
    rolled = counts.counts_by(events, ["dt", "repo_name", "event_type"], "n")
    assert tuples(marts.top_repos(events, DAYS)) == tuples(marts.top_repos(rolled, DAYS, weight="n"))
    assert tuples(marts.top_event_types(events, DAYS)) == tuples(
        marts.top_event_types(rolled, DAYS, weight="n")
    )
    assert tuples(marts.daily_top_repos(events, DAYS)) == tuples(
        marts.daily_top_repos(rolled, DAYS, weight="n")
    )


@pytest.mark.parametrize(
    "ref, group",
    [
        (None, "unknown"),
        ("main", "main"),
        ("refs/heads/main", "main"),
        ("refs/heads/master", "master"),
        ("refs/tags/v1", "other"),
        ("refs/heads/feature/refs/heads/main", "other"),
    ],
)
def test_branch_group(spark, ref, group):
    df = spark.createDataFrame([(ref,)], "ref string")
    assert df.select(branch_group("ref")).first()[0] == group


def test_push_branch_ratio(spark):
    refs = ["main", "refs/heads/main", None, "refs/tags/v1"]
    pushes = spark.createDataFrame([(D1, "r", ref) for ref in refs],
                                   "dt date, repo_name string, ref string")
    got = marts.push_branch_ratio(pushes, DAYS).orderBy("branch_group")
    assert tuples(got, "branch_group", "push_count", "total_push_count", "branch_ratio") == [
        ("main", 2, 4, 0.5), ("other", 1, 4, 0.25), ("unknown", 1, 4, 0.25),
    ]


def test_resolve_days():
    today = dt.date(2024, 3, 1)
    assert resolve_days(date=D1) == Days(D1, D1)
    assert resolve_days(start=D1) == Days(D1, D1)
    assert resolve_days(start=D1, end=D2) == DAYS
    assert resolve_days(today=today) == Days(dt.date(2024, 2, 29), dt.date(2024, 2, 29))
    with pytest.raises(ValueError):
        resolve_days(end=D2)
    with pytest.raises(ValueError):
        resolve_days(date=D1, start=D2)


PR = (
    "repo_name string, created_at_ts timestamp, action string, pull_request_id long, "
    "pull_request_merged boolean, pull_request_merged_at string, commit_count int, "
    "additions int, deletions int, changed_files int"
)
REVIEW = (
    "repo_name string, pull_request_id long, review_id long, review_state string, "
    "review_submitted_at string"
)
COMMENT = "repo_name string, pull_request_id long, comment_id long, comment_created_at string"


def at(hour, day=1):
    return dt.datetime(2024, 1, day, hour, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def pr_tables(spark):
    prs = [
        ("r", at(10), "opened", 1, False, None, 1, 5, 0, 1),
        ("r", at(9), "opened", 1, False, None, 3, 2, 0, 1),
        ("r", at(20), "closed", 1, True, "2024-01-01T20:00:00Z", 2, 9, 4, 2),
        ("r", at(12), "closed", 2, True, "2024-01-01T12:00:00Z", 1, 1, 1, 1),  # never opened
        ("r", at(12), "opened", None, False, None, 1, 1, 1, 1),
        ("r", at(12), "opened", 3, False, None, 1, 1, 1, 1),
        (None, at(12), "opened", 4, False, None, 1, 1, 1, 1),
    ]
    reviews = [
        ("r", 1, 11, "approved", "2024-01-01T08:00:00Z"),  # before the opening
        ("r", 1, 11, "approved", "2024-01-01T12:00:00Z"),  # the same review again
        ("r", 1, 12, "commented", "bad time"),
        ("r", 1, None, "approved", "2024-01-01T01:00:00Z"),
        (None, 4, 13, "approved", "2024-01-01T13:00:00Z"),  # matches no repository
    ]
    comments = [("r", 1, 21, "2024-01-01T10:30:00Z"), ("r", 1, 21, "2024-01-01T11:30:00Z")]
    return (
        spark.createDataFrame(prs, PR),
        spark.createDataFrame(reviews, REVIEW),
        spark.createDataFrame(comments, COMMENT),
    )


def test_pull_request_base(pr_tables):
    got = {r.pull_request_id: r for r in pull_requests.pull_request_base(pr_tables[0]).collect()}
    assert set(got) == {1, 3, 4}
    one = got[1]
    assert one.opened_at.hour == 9 and one.merged_at.hour == 20 and one.dt == D1
    assert (one.pull_request_merged, one.commit_count, one.additions) == (True, 3, 9)
    assert (one.deletions, one.changed_files) == (4, 2)


def test_enriched_pull_requests(pr_tables):
    got = {r.pull_request_id: r for r in latency.enriched_pull_requests(*pr_tables).collect()}
    one, three, four = got[1], got[3], got[4]
    assert (one.review_count, one.approval_count, one.review_comment_count) == (2, 2, 1)
    assert (one.first_review_hours, one.first_review_comment_hours) == (-1.0, 1.5)
    for pr in (three, four):
        assert (pr.review_count, pr.approval_count, pr.review_comment_count) == (0, 0, 0)
        assert (pr.first_review_hours, pr.reviewed_pr) == (None, 0)


def test_review_latency_mart(pr_tables):
    mart = marts.pull_request_review_latency(*pr_tables, DAYS)
    got = {r.repo_name: r for r in mart.collect()}
    row = got["r"]
    assert (row.dt, row.pr_count, row.reviewed_pr_count, row.start_dt) == (D1, 2, 1, D1)
    assert (row.avg_first_review_hours, row.p90_first_review_hours) == (-1.0, -1.0)
    assert (row.avg_repo_review_speed_rank, row.p90_repo_review_speed_rank) == (1.5, 2)
    assert (row.avg_pr_gap_hours, row.max_rolling_pr_count_50) == (3.0, 2)
    assert (got[None].p95_first_review_hours, got[None].avg_pr_gap_hours) == (None, None)
    assert len(mart.columns) == 2 + 18 + 2


@pytest.mark.parametrize("n", [1, 2, 9, 10, 19, 20, 21, 999])
def test_percentiles_equal_percentile_approx_on_small_groups(spark, n):
    from strata.operators.pr_windows import opening_windows, speed_windows

    prs = spark.range(n).select(
        F.lit("r").alias("repo_name"),
        F.lit(D1).alias("dt"),
        F.timestamp_seconds("id").alias("opened_at"),
        F.col("id").alias("pull_request_id"),
        F.when(F.col("id") % 3 != 0, (F.col("id") * 7 % 31).cast("double")).alias(
            "first_review_hours"
        ),
        *(F.lit(0).cast("long").alias(c)
          for c in ("reviewed_pr", "review_count", "review_comment_count", "approval_count")),
        F.lit(0.0).alias("first_review_comment_hours"),
    )
    windowed = speed_windows(opening_windows(prs))
    got = latency.review_latency(windowed).first()
    want = windowed.agg(
        F.percentile_approx("first_review_hours", 0.9).alias("p90"),
        F.percentile_approx("first_review_hours", 0.95).alias("p95"),
        F.percentile_approx("repo_review_speed_rank", 0.9).alias("rank"),
    ).first()
    assert (
        got.p90_first_review_hours, got.p95_first_review_hours, got.p90_repo_review_speed_rank,
    ) == tuple(want)
