"""Round trip over files: landed lines to silver, drift and gold, and the bookkeeping."""

import datetime as dt
import glob
import gzip
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import manifest
from strata.plans import jobs, marts
from strata.plans.marts import Days
from strata.session import shared_folder
from strata.sources import bronze, gold, metadata, silver

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
D3 = dt.date(2024, 1, 3)


def land(root, day, hour, lines):
    folder = os.path.join(root, f"{day:%Y/%m/%d}")
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, f"{day:%Y-%m-%d}-{hour}.json.gz"), "wt") as file:
        file.writelines(line + "\n" for line in lines)


def event(id, kind, payload, day, hour, repo="o/r", actor="ann"):
    return json.dumps(
        {
            "id": str(id),
            "type": kind,
            "actor": {"id": 1, "login": actor},
            "repo": {"id": 2, "name": repo},
            "payload": payload,
            "public": True,
            "created_at": f"{day}T{hour:02}:00:00Z",
        }
    )


def push(id, day, hour, **more):
    payload = {"push_id": id, "ref": "refs/heads/main", **more}
    return event(id, "PushEvent", payload, day, hour)


PR = {"id": 77, "number": 3, "title": "t", "merged": False, "commits": 1}


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    land(
        root,
        D1,
        7,
        [
            push(1, D1, 7, size=1, distinct_size=1, commits=[{"sha": "s"}]),
            event(2, "WatchEvent", {"action": "started"}, D1, 7),
            event(3, "PullRequestEvent", {"action": "opened", "pull_request": PR}, D1, 7),
            "{broken",
            "",
            push(4, D2, 0, size=1),  # another day's event in this file
        ],
    )
    land(
        root,
        D1,
        10,
        [
            event(
                5,
                "PullRequestReviewEvent",
                {
                    "action": "created",
                    "review": {"id": 9, "state": "approved", "submitted_at": f"{D1}T10:00:00Z"},
                    "pull_request": PR,
                },
                D1,
                10,
            ),
            json.dumps({"id": "6", "type": "WatchEvent", "created_at": "never"}),
        ],
    )
    land(root, D2, 0, [push(7, D2, 0), event(8, "ForkEvent", {}, D2, 0)])
    land(root, D2, 1, [])
    return root


@pytest.fixture(scope="module")
def lake(spark, landing, tmp_path_factory):
    """Both days, day by day."""
    root = str(tmp_path_factory.mktemp("lake"))
    reports = [jobs.run_silver(spark, landing, root, Days(d, d)) for d in (D1, D2)]
    assert reports == [
        {"lines": 8, "faulty": 2, "dropped": 1, "other_day": 1, "kept": 4},
        {"lines": 2, "faulty": 0, "dropped": 0, "other_day": 0, "kept": 2},
    ]
    return root


def table(spark, lake, name):
    return silver.read_table(spark, jobs.silver_root(lake), name)


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_read_lines_with_their_file(spark, landing):
    lines = bronze.read_hour(spark, landing, dt.datetime(2024, 1, 1, 7)).collect()
    assert len(lines) == 6
    assert all(r.source_file.endswith("2024-01-01-7.json.gz") for r in lines)
    assert bronze.read_day(spark, landing, D1).count() == 8
    assert bronze.read_days(spark, landing, D1, D2).count() == 10


def test_a_day_without_files_is_an_error(spark, landing):
    with pytest.raises(FileNotFoundError):
        bronze.read_day(spark, landing, dt.date(2023, 5, 5))
    with pytest.raises(FileNotFoundError):
        bronze.read_hour(spark, landing, dt.datetime(2024, 1, 1, 23))
    with pytest.raises(FileNotFoundError):
        bronze.read_days(spark, landing, D1, dt.date(2024, 1, 3))


def test_silver_tables(spark, lake):
    base = table(spark, lake, "events_base")
    assert ids(base) == ["1", "2", "3", "5", "7", "8"]
    assert base.select("source_file").where("source_file LIKE '%2024-01-01-7%'").count() == 3
    assert ids(table(spark, lake, "events_push")) == ["1", "7"]
    assert ids(table(spark, lake, "push_commits")) == ["1"]
    assert ids(table(spark, lake, "events_fork")) == ["8"]


def test_a_table_without_rows_still_reads(spark, lake):
    release = table(spark, lake, "events_release")
    assert release.count() == 0
    assert "release_tag_name" in release.columns


def test_a_range_run_equals_day_by_day_runs(spark, landing, lake, tmp_path):
    both = str(tmp_path)
    jobs.run_silver(spark, landing, both, Days(D1, D2))
    for name in ("events_base", "events_push", "events_watch"):
        one, other = table(spark, lake, name), table(spark, both, name)
        assert one.count() == other.count()
        assert one.exceptAll(other).count() == 0


def test_rerun_replaces_the_day_and_keeps_the_others(spark, landing, lake):
    jobs.run_silver(spark, landing, lake, Days(D2, D2), repartition=2)
    assert ids(table(spark, lake, "events_base")) == ["1", "2", "3", "5", "7", "8"]
    jobs.run_silver(spark, landing, lake, Days(D1, D1), coalesce=1)
    assert ids(table(spark, lake, "events_base")) == ["1", "2", "3", "5", "7", "8"]
    with pytest.raises(ValueError):
        jobs.run_silver(spark, landing, lake, Days(D1, D1), repartition=1, coalesce=1)


def test_an_empty_write_leaves_the_old_day(spark, tmp_path):
    rows = spark.createDataFrame([("1", D1)], "event_id string, dt date")
    silver.write_days(rows, str(tmp_path), "t")
    silver.write_days(rows.where("false"), str(tmp_path), "t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1


def test_day_ranges_prune_partitions(spark, lake):
    root = jobs.silver_root(lake)
    df = silver.read_for_marts(spark, root, "events_base", D2, D2)
    assert df.columns == silver.MART_COLUMNS["events_base"]
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert "payload_raw" not in plan


def test_a_day_is_read_from_its_folder_alone(spark, tmp_path):
    """The file index holds the range's files: no other day is ever listed."""
    rows = spark.range(300).selectExpr(
        "CAST(id AS STRING) AS event_id", "date_add(DATE '2024-01-01', CAST(id % 30 AS INT)) AS dt"
    )
    silver.write_days(rows, str(tmp_path), silver.BASE)
    (tmp_path / silver.BASE / "dt=nonsense").mkdir()
    whole = silver.read_table(spark, str(tmp_path), silver.BASE)
    one = silver.read_days(spark, str(tmp_path), silver.BASE, D2, D2)
    listed = one._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().inputFiles()
    assert len(listed) >= 1 and all(f"dt={D2}/" in file for file in listed)
    assert one.count() == 10 and one.columns == whole.columns
    assert silver.read_days(spark, str(tmp_path), silver.BASE, D1, D3).count() == 30
    gone = silver.read_days(spark, str(tmp_path), silver.BASE, dt.date(2025, 1, 1), dt.date(2025, 1, 2))
    assert gone.count() == 0 and gone.schema == whole.schema


def test_audit_reads_footers_in_one_scan(spark, lake):
    audit = jobs.silver_audit(spark, lake, Days(D1, D3))
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "ReadSchema: struct<>" in plan


def test_counts_are_gathered_in_the_tasks_that_write(spark, landing):
    """Above the last shuffle: a map stage that is run again cannot count its lines twice."""
    lines = bronze.read_day(spark, landing, D1)
    rows, seen = jobs.base_rows(lines, Days(D1, D1), repartition=3)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange") < plan.index("from_json")
    assert rows.count() == 4
    assert seen.get == {"lines": 8, "faulty": 2, "dropped": 1, "other_day": 1, "kept": 4}


def test_counts_stay_exact_where_a_stage_runs_again(spark, tmp_path):
    """The first writing task loses the shuffle's files, so the map stage is run once more."""
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    folders = [d.getPath() for d in env.blockManager().diskBlockManager().localDirs()]
    once = str(tmp_path / "once")

    @F.udf("boolean")
    def lose_shuffle(_):
        try:
            os.close(os.open(once, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return True
        for folder in folders:
            for file in glob.glob(f"{folder}/*/shuffle_*.data"):
                os.remove(file)
        return True

    lines = [push(i, D1, 7) for i in range(400)] + ["{broken"] * 7 + [push(i, D2, 7) for i in range(9)]
    raw = spark.createDataFrame([(x, "a/2024-01-01-7.json.gz") for x in lines], "raw_json string, source_file string")
    rows, seen = jobs.base_rows(raw, Days(D1, D1), repartition=40)
    spark.sparkContext.setJobGroup("lost", "a shuffle is lost")
    try:
        rows.where(lose_shuffle("event_id")).write.format("noop").mode("overwrite").save()
        tracker = spark.sparkContext.statusTracker()
        stages = [s for job in tracker.getJobIdsForGroup("lost") for s in tracker.getJobInfo(job).stageIds]
        infos = filter(None, map(tracker.getStageInfo, stages))
        assert any(info.currentAttemptId > 0 for info in infos)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert seen.get == {"lines": 416, "faulty": 7, "dropped": 0, "other_day": 9, "kept": 400}


def test_audit(spark, lake):
    got = {
        (r.dataset, r.dt): r for r in jobs.silver_audit(spark, lake, Days(D1, D3)).collect()
    }
    assert len(got) == 18 * 3
    assert got["events_base", D1].rows == 4
    assert got["events_base", D1].files >= 1 and got["events_base", D1].bytes > 0
    path = f"{silver.table_path(jobs.silver_root(lake), 'events_base')}/dt={D1}"
    sizes = [os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")]
    assert (got["events_base", D1].files, got["events_base", D1].bytes) == (len(sizes), sum(sizes))
    for gap in (("events_release", D1), ("events_base", D3)):
        assert tuple(got[gap][name] for name in ("files", "bytes", "rows", "missing")) == (0, 0, 0, True)
    assert not got["events_base", D1].missing
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        silver.audit_days(spark, lake + "/nowhere", "events_base", D1, D2)


def test_profile_of_all_tracks(spark, lake):
    got = {r.track: (r.rows, r.payload_ok) for r in jobs.silver_profile(spark, lake, Days(D1, D2)).collect()}
    assert len(got) == 17 and got["events_release"] == (0, 0)
    assert got["events_push"][0] == table(spark, lake, "events_push").count()


def test_gold_marts(spark, lake):
    days = Days(D1, D2)
    names = jobs.run_gold(spark, lake, days)
    root = jobs.gold_root(lake)
    daily = {"daily_top_repos", "push_branch_ratio", "pull_request_review_latency"}
    read = {
        name: spark.read.parquet(f"{root}/{name}") if name in daily else gold.read_mart(spark, f"{root}/{name}")
        for name in names
    }
    assert len(names) == 8
    top = read["top_repos"].collect()
    assert [(r.repo_name, r.repo_event_count, r.start_dt, r.end_dt) for r in top] == [
        ("o/r", 6, D1, D2)
    ]
    direct = marts.top_actor_event_types(
        silver.read_for_marts(spark, jobs.silver_root(lake), "events_base", D1, D2),
        read["top_actors"],
        days,
    )
    assert read["top_actor_event_types"].exceptAll(direct).count() == 0
    assert read["push_branch_ratio"].count() == 2
    latency = read["pull_request_review_latency"].first()
    assert (latency.pr_count, latency.avg_first_review_hours) == (1, 3.0)

    # Another day: whole marts are replaced, daily ones keep the days not in the run.
    jobs.run_gold(spark, lake, Days(D2, D2), daily_top_n=0, actor_metric="distinct_repo")
    assert gold.read_mart(spark, f"{root}/top_repos").first().repo_event_count == 2
    assert gold.read_mart(spark, f"{root}/top_actors").columns[1] == "actor_repo_count"
    assert spark.read.parquet(f"{root}/push_branch_ratio").count() == 2
    assert spark.read.parquet(f"{root}/daily_top_repos").count() == 2


def test_gold_csv_and_unknown_formats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, D1)], "name string, n long, dt date")
    gold.write_mart(df, f"{tmp_path}/csv", "csv", files=1)
    got = gold.read_mart(spark, f"{tmp_path}/csv", "csv", df.schema)
    assert got.first().name == "a" and got.schema == df.schema
    assert spark.read.option("header", True).csv(gold.mart_path(spark, f"{tmp_path}/csv")).count() == 1
    gold.write_mart(df, f"{tmp_path}/by_day", partition_by="dt")
    assert os.listdir(f"{tmp_path}/by_day").count(f"dt={D1}") == 1
    with pytest.raises(ValueError):
        gold.write_mart(df, f"{tmp_path}/x", "orc")


def test_a_sorted_daily_mart_is_one_file_per_day(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id % 5 AS INT)) AS dt")
    gold.write_mart(df.repartition(8).orderBy("id"), str(tmp_path / "m"), partition_by="dt")
    files = (
        spark.read.parquet(str(tmp_path / "m")).select("dt", "_metadata.file_path").distinct()
    )
    assert files.count() == 5


def test_drift_over_two_days(spark, lake):
    root = jobs.metadata_root(lake)
    first = {r.track: r for r in jobs.run_drift(spark, lake, D1).collect()}
    assert first["events_push"].drift_detected
    assert first["events_create"].drift_reasons == ["no data"]
    registry, version = metadata.read_registry(spark, root)
    assert (version, registry.count()) == (2, 4)

    again = {r.track: r for r in jobs.run_drift(spark, lake, D1).collect()}
    assert again == first  # a rerun judges against earlier days, not against itself
    assert metadata.registry_version(spark, root) == 2

    second = {r.track: r for r in jobs.run_drift(spark, lake, D2).collect()}
    assert second["events_push"].new_variant_count == 1
    registry, version = metadata.read_registry(spark, root)
    days = {(r.track, r.first_seen_dt) for r in registry.collect()}
    assert version == 3
    assert ("events_push", D1) in days and ("events_push", D2) in days

    results = spark.read.json(f"{root}/drift_results")
    assert results.count() == 2  # the rerun of a day replaced its document
    document = results.where(F.col("target_date") == F.lit(D2)).first()
    assert len(document.track_results) == 8 and document.written_at
    listed = spark.read.json(f"{root}/drift_variants").where("is_new").collect()
    firsts = {name for name, day in days if day == D1}
    assert {(r.target_date, r.track) for r in listed} == {
        *((D1, name) for name in firsts), (D2, "events_push"), (D2, "events_fork"),
    }
    assert metadata.read_history(spark, root).count() == 3


def test_drift_without_any_silver_table(spark, tmp_path):
    got = jobs.run_drift(spark, str(tmp_path), D1, tracks=["events_push", "events_fork"]).collect()
    assert [r.drift_reasons for r in got] == [["no data"], ["no data"]]
    assert metadata.registry_version(spark, jobs.metadata_root(str(tmp_path))) == 1


def test_hour_manifest(spark):
    due = manifest.hour_manifest(manifest.days(spark, D1, D2), "raw/", "https://example.org/")
    got = due.orderBy("dt", "hour_of_day").collect()
    assert len(got) == 48
    assert got[7].source_name == "2024-01-01-7.json.gz"
    assert got[7].landing_key == "raw/2024/01/01/2024-01-01-7.json.gz"
    assert got[34].source_url == "https://example.org/2024-01-02-10.json.gz"


def test_missing_hours_and_summary(spark, landing):
    due = manifest.hour_manifest(manifest.days(spark, D1, D2))
    files = bronze.landed_files(spark, landing, D1, D3)
    assert files.count() == 4
    assert bronze.landed_files(spark, landing, D1, D1).count() < 4
    assert bronze.landed_files(spark, landing, D3, D3).count() == 0
    missing = manifest.missing_hours(due, files)
    assert missing.count() == 44
    before = files.where("source_name LIKE '2024-01-01-7.%'")
    emptied = files.withColumn(
        "bytes", F.when(F.col("source_name") == "2024-01-02-1.json.gz", 0).otherwise(F.col("bytes"))
    )
    status = manifest.ingest_status(due, before, emptied)
    got = {r.status: r.hours for r in manifest.ingest_summary(status).collect()}
    assert got == {"skipped": 1, "ok": 2, "failed": 45}


def test_jobs_leave_no_scratch_folder(spark, lake):
    def left():
        root = f"{shared_folder(spark)}/strata"
        return set(os.listdir(root)) if os.path.isdir(root) else set()

    before = left()
    jobs.run_gold(spark, lake, Days(D1, D2), slice_rows=1)
    jobs.run_drift(spark, lake, D2)
    assert left() == before


def test_jobs_want_utc(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            jobs.run_gold(spark, lake, Days(D1, D2))
        with pytest.raises(ValueError, match="UTC"):
            jobs.run_drift(spark, lake, D1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_gold_of_the_tracks_it_reads_and_the_others_written_later(spark, landing, lake, tmp_path):
    days, part = Days(D1, D2), str(tmp_path)
    names = [name for name in silver.MART_COLUMNS if name != silver.BASE]
    report = jobs.load_base(bronze.read_days(spark, landing, D1, D2), part, days)
    jobs.write_tracks(spark, part, days, names)
    assert sorted(os.listdir(jobs.silver_root(part))) == sorted([silver.BASE, *names])
    assert len(jobs.run_gold(spark, part, days)) == 8
    jobs.write_tracks(spark, part, days, [name for name in jobs.TRACKS if name not in names])
    assert report["lines"] == sum(report[outcome] for outcome in jobs.events.OUTCOMES)
    for name in (silver.BASE, *jobs.TRACKS):
        whole, later = (silver.read_days(spark, jobs.silver_root(at), name, D1, D2) for at in (lake, part))
        assert whole.count() == later.count()
        assert whole.drop("source_file").exceptAll(later.drop("source_file")).count() == 0
