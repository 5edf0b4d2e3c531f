"""Windows over pull requests: the sliced way gives the rows of the plain one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import latency, pr_windows

EPOCH = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
PR_SCHEMA = (
    "repo_name string, created_at_ts timestamp, action string, pull_request_id long, "
    "pull_request_merged boolean, pull_request_merged_at string, commit_count int, "
    "additions int, deletions int, changed_files int"
)


def pr_tables(spark, prs_by_repo, seed=7):
    """Opened PRs with few distinct times, so that ties and long groups of peers occur."""
    rng = random.Random(seed)
    prs, reviews, comments = [], [], []
    pr = 0
    for repo, n in prs_by_repo.items():
        for _ in range(n):
            pr += 1
            opened = EPOCH + dt.timedelta(hours=rng.randrange(40))
            prs.append((repo, opened, "opened", pr, False, None, 1, 2, 3, 4))
            if rng.random() < 0.5:
                for review in range(rng.randrange(1, 3)):
                    at = opened + dt.timedelta(hours=rng.choice([-2, 0, 1, 1, 1, 5, 30]))
                    reviews.append(
                        (repo, pr, review, "approved", at.strftime("%Y-%m-%dT%H:%M:%SZ"))
                    )
            if rng.random() < 0.3:
                at = opened + dt.timedelta(hours=rng.randrange(9))
                comments.append((repo, pr, pr * 10, at.strftime("%Y-%m-%dT%H:%M:%SZ")))
    return (
        spark.createDataFrame(prs, PR_SCHEMA),
        spark.createDataFrame(
            reviews,
            "repo_name string, pull_request_id long, review_id long, review_state string, "
            "review_submitted_at string",
        ),
        spark.createDataFrame(
            comments,
            "repo_name string, pull_request_id long, comment_id long, comment_created_at string",
        ),
    )


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    # One repository holds most of the rows, one has no name, one has a single PR.
    return pr_tables(spark, {"hot": 700, None: 150, "a": 60, "b": 8, "solo": 1})


# The largest repositories have 700 and 150 pull requests: below, at and above those sizes.
@pytest.mark.parametrize("slice_rows", [701, 700, 699, 600, 151, 150, 149, 100, 40])
def test_sliced_windows_equal_plain_ones(tables, slice_rows):
    plain = latency.windowed_pull_requests(*tables)
    sliced = latency.windowed_pull_requests(*tables, slice_rows=slice_rows)
    assert plain.count() == 919
    assert plain.schema.simpleString() == sliced.select(plain.columns).schema.simpleString()
    assert rows(plain) == rows(sliced)


def test_large_repos_are_found_by_openings_null_repo_included(spark, tables):
    assert pr_windows.has_large_repo(tables[0], 699)
    assert not pr_windows.has_large_repo(tables[0], 700)
    nameless = tables[0].where("repo_name IS NULL")
    assert pr_windows.has_large_repo(nameless, 149) and not pr_windows.has_large_repo(nameless, 150)


def test_slices_share_a_large_group_out(spark):
    df = spark.range(40_000).selectExpr("id % 2 = 0 AS k", "id % 7 AS v", "id")
    slices = pr_windows.cut(df, "s", ["k"], F.col("v"), "id", 2_000)
    sizes = [r["count"] for r in slices.assign(df).groupBy("k", "s_slice").count().collect()]
    assert len(sizes) == 20 and sum(sizes) == 40_000 and max(sizes) < 3_500
    none = pr_windows.cut(df, "s", ["k"], F.col("v"), "id", 20_000)
    assert none.cuts is None and none.parts == ["k"]


@pytest.mark.parametrize("slice_rows", [3, 11, 60, 149])
def test_carried_numbers_match_brute_force(spark, slice_rows):
    rng = random.Random(slice_rows)
    data = [(rng.choice(["x", "x", "x", None]), rng.choice([1, 1, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, v int, id int").withColumn("w", F.col("v"))
    slices = pr_windows.cut(df, "s", ["k"], F.col("v"), "id", slice_rows, {"odd": F.count_if(F.col("v") % 2 == 1)})
    got = slices.carry(slices.assign(df)).select(
        "k",
        "v",
        "id",
        slices.row_number().alias("pos"),
        slices.percent_rank().alias("rank"),
        slices.total("rows", F.count(F.lit(1))).alias("n"),
        slices.total("odd", F.count_if(F.col("v") % 2 == 1)).alias("odd"),
    )
    expected = []
    for k, v, i in data:
        group = [r for r in data if r[0] == k]
        expected.append(
            (
                k,
                v,
                i,
                1 + sum((r[1], r[2]) < (v, i) for r in group),
                sum(r[1] < v for r in group) / (len(group) - 1),
                len(group),
                sum(r[1] % 2 for r in group),
            )
        )
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def exchanges(df):
    """Shuffles of rows: broadcasts of small tables are others."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_an_ordering_shuffles_the_rows_once(spark):
    prs = spark.range(1_000).select(
        (F.col("id") % 1).cast("string").alias("repo_name"),
        F.timestamp_seconds(F.col("id") * 400).alias("opened_at"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 2).cast("int")).alias("dt"),
        F.col("id").alias("pull_request_id"),
        (F.col("id") % 10).cast("double").alias("first_review_hours"),
    )
    assert exchanges(pr_windows.sliced_windows(prs, 5_000)) == 1
    sliced = pr_windows.sliced_windows(prs, 100)
    # Three orderings, and the tails that are handed on as context.
    assert exchanges(sliced) <= 4
    plain = pr_windows.speed_windows(pr_windows.opening_windows(prs))
    assert rows(sliced) == rows(plain.select(sliced.columns))


def test_opening_windows_golden(spark):
    at = [EPOCH + dt.timedelta(hours=h) for h in (0, 2, 2, 5)]
    prs = spark.createDataFrame(
        [("r", at[i], pr, h) for i, (pr, h) in enumerate([(9, 1.0), (4, None), (3, 3.0), (1, 8.0)])],
        "repo_name string, opened_at timestamp, pull_request_id long, first_review_hours double",
    )
    got = pr_windows.opening_windows(prs).orderBy("opened_at", "pull_request_id")
    picked = got.select(
        "pull_request_id",
        "pr_gap_hours",
        "rolling_pr_count_50",
        "rolling_avg_first_review_hours_50",
    )
    assert [tuple(r) for r in picked.collect()] == [
        (9, None, 1, 1.0),
        (3, 2.0, 2, 2.0),
        (4, 0.0, 3, 2.0),
        (1, 3.0, 4, 4.0),
    ]


def test_rolling_frame_is_51_rows(spark):
    prs = spark.range(120).select(
        F.lit("r").alias("repo_name"),
        F.timestamp_seconds("id").alias("opened_at"),
        F.col("id").alias("pull_request_id"),
        F.col("id").cast("double").alias("first_review_hours"),
    )
    last = pr_windows.opening_windows(prs).where("pull_request_id = 119").first()
    assert last.rolling_pr_count_50 == 51
    assert last.rolling_avg_first_review_hours_50 == sum(range(69, 120)) / 51


def test_speed_windows_peers_and_unreviewed(spark):
    day = dt.date(2024, 1, 1)
    prs = spark.createDataFrame(
        [("r", day, pr, h) for pr, h in [(1, 5.0), (2, None), (3, -1.0), (4, 5.0), (5, None)]],
        "repo_name string, dt date, pull_request_id long, first_review_hours double",
    )
    got = {
        r.pull_request_id: (
            r.repo_review_speed_rank,
            r.repo_review_speed_percent_rank,
            r.daily_review_speed_rank,
        )
        for r in pr_windows.speed_windows(prs).collect()
    }
    assert got == {
        3: (1, 0.0, 1),
        1: (2, 0.25, 2),
        4: (3, 0.25, 3),
        2: (4, 0.75, 4),
        5: (5, 0.75, 5),
    }


def test_groups_of_very_many_slices_are_cut_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(pr_windows, "FAN", 4)
    df = spark.range(3_000).selectExpr("id % 3 < 2 AS k", "id % 7 AS v", "id")
    slices = pr_windows.cut(df, "s", ["k"], F.col("v"), "id", 100)
    # 2,000 rows are cut into 4, 4 times 4 and some of these again; no row meets more cuts.
    assert len(slices.cuts) == 3
    assert all(c.agg(F.max(F.size("cuts"))).first()[0] <= 3 for c in slices.cuts)
    sizes = [r["count"] for r in slices.assign(df).groupBy("k", "s_slice").count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) <= 200
    got = slices.carry(slices.assign(df)).select("k", "v", "id", slices.row_number().alias("pos"))
    expected = {}
    for k, v, i in sorted((i % 3 < 2, i % 7, i) for i in range(3_000)):
        expected.setdefault(k, []).append((k, v, i, len(expected.get(k, ())) + 1))
    assert sorted(map(tuple, got.collect())) == [r for k in (False, True) for r in expected[k]]
