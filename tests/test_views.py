"""The derived tables at rest: what they are made from, and how often."""

import datetime as dt

from strata.workload import views


def write_orders(spark, folder):
    orders = [(i, i % 9, "F", dt.datetime(2020, 1, 1)) for i in range(60)]
    lines = [(i // 3, i % 3, i, "A", "O", dt.datetime(2020, 1, 2)) for i in range(180)]
    spark.createDataFrame(
        orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"
    ).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(
        lines,
        "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{folder}/lineitem.parquet")


def test_reviews_and_comments_share_one_join(spark, tmp_path, monkeypatch):
    write_orders(spark, tmp_path)
    joins = []
    monkeypatch.setattr(
        views, "_reviewed_lines", lambda *a, make=views._reviewed_lines: joins.append(a) or make(*a)
    )
    reviews = views.reviews(spark, str(tmp_path))
    comments = views.review_comments(spark, str(tmp_path))
    assert reviews.count() == 180 and comments.count() == 180 and len(joins) == 1
    plan = reviews._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_lines_of_a_file_lie_in_one_part_and_the_code_limit_is_put_back(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(i, start + dt.timedelta(minutes=i), i % 5, "click", '{"k": 3}') for i in range(600)]
    spark.createDataFrame(
        rows, "event_id long, ts timestamp, user_id long, event_type string, props string"
    ).write.parquet(f"{tmp_path}/events.parquet")
    limit = spark.conf.get(views._METHOD_LIMIT)
    lines = views.raw_lines(spark, str(tmp_path))
    assert spark.conf.get(views._METHOD_LIMIT) == limit
    parts = lines.selectExpr("source_file", "_metadata.file_path AS part").distinct()
    assert lines.count() == 600
    assert parts.count() == parts.select("source_file").distinct().count()


def test_silver_and_drift_queries_build_no_gold(spark, monkeypatch):
    from strata.workload import queries

    built = []
    monkeypatch.setattr(queries.jobs, "load_silver", lambda lines, lake, days: {"lines": 1})
    monkeypatch.setattr(queries.jobs, "run_gold", lambda spark, lake, days: built.append(lake))
    monkeypatch.setattr(queries.views, "raw_lines", lambda *a: None)
    monkeypatch.setattr(queries, "span", lambda *a: None)
    lake, report = queries._silver_lake(spark, "/nowhere")
    assert report == {"lines": 1} and not built
    assert queries._gold_lake(spark, "/nowhere") == queries._gold_lake(spark, "/nowhere") == lake
    assert built == [lake]


def test_gold_queries_write_only_tracks_that_gold_reads_and_silver_queries_add_the_rest(spark, monkeypatch):
    from strata.operators.tracks import TRACKS
    from strata.workload import queries

    begun, written, built = [], [], []
    monkeypatch.setattr(queries.jobs, "load_base", lambda lines, lake, days: begun.append(lake) or {"lines": 1})
    monkeypatch.setattr(queries.jobs, "write_tracks", lambda spark, lake, days, names: written.append((lake, list(names))))
    monkeypatch.setattr(queries.jobs, "run_gold", lambda spark, lake, days: built.append(lake))
    monkeypatch.setattr(queries.views, "raw_lines", lambda *a: None)
    monkeypatch.setattr(queries, "span", lambda *a: None)
    lake = queries._gold_lake(spark, "/nowhere/gold")
    assert queries._gold_lake(spark, "/nowhere/gold") == lake
    needed = {name for name in queries.silver.MART_COLUMNS if name != "events_base"}
    assert len(written) == 1 and written[0][0] == lake and set(written[0][1]) == needed
    assert queries._silver_lake(spark, "/nowhere/gold") == (lake, {"lines": 1})
    assert queries._silver_lake(spark, "/nowhere/gold") == (lake, {"lines": 1})
    assert queries._gold_lake(spark, "/nowhere/gold") == lake
    assert begun == built == [lake] and [where for where, _ in written] == [lake, lake]
    assert sorted(written[0][1] + written[1][1]) == sorted(TRACKS)
