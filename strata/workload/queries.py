"""One query per operator: (spark, table folder) to a DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import in_days
from strata.operators import (
    counts,
    drift,
    events,
    latency,
    manifest,
    profile,
    pull_requests,
    pushes,
    tracks,
)
from strata.plans import jobs, marts
from strata.session import materialize, scratch_path
from strata.sources import bronze, gold, metadata, silver
from strata.workload import rules, views

Query = Callable[[SparkSession, str], DataFrame]

JANUARY = marts.Days(dt.date(2024, 1, 1), dt.date(2024, 1, 31))
ALL_ORDERS = marts.Days(dt.date(1990, 1, 1), dt.date(2010, 12, 31))
DRIFT_DAY = dt.date.fromisoformat(rules.DRIFT_DAY)
# Far below any real size: the large repository of the benchmark tables is cut into slices.
SLICE_ROWS = 250

_queries: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    _queries[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, timestamps to epoch seconds: comparable across engines.

    Engines round a tie such as 0.5046875 differently, so halves are sent up by hand.
    """
    shown = {
        "double": lambda c: F.floor(F.col(c) * 1e6 + 0.5) / F.lit(1e6),
        "timestamp": lambda c: F.unix_timestamp(c),
    }
    return df.select(
        *(shown.get(kind, lambda c: F.col(c))(name).alias(name) for name, kind in df.dtypes)
    )


# --- scans, filters, counts --------------------------------------------------------------


@query
def scan_events_range(spark, sf_dir):
    days = in_days(dt.date(2024, 1, 8), dt.date(2024, 1, 23))
    return views.events(spark, sf_dir).where(days).select(*silver.MART_COLUMNS[silver.BASE])


@query
def actor_filter(spark, sf_dir):
    return counts.with_actor(views.events(spark, sf_dir))


@query
def date_range_stamp(spark, sf_dir):
    return JANUARY.stamp(views.events(spark, sf_dir).select("event_id"))


@query
def repo_counts(spark, sf_dir):
    found = counts.repo_counts(views.events(spark, sf_dir))
    return counts.largest(found, "repo_event_count", "repo_name")


@query
def actor_counts(spark, sf_dir):
    found = counts.actor_counts(views.events(spark, sf_dir))
    return counts.largest(found, "actor_event_count", "actor_login")


@query
def actor_distinct_repos(spark, sf_dir):
    found = counts.actor_distinct_repo_counts(views.events(spark, sf_dir))
    return counts.largest(found, "actor_repo_count", "actor_login")


@query
def daily_repo_counts(spark, sf_dir):
    return counts.daily_repo_counts(views.events(spark, sf_dir))


@query
def event_type_counts(spark, sf_dir):
    found = counts.event_type_counts(views.events(spark, sf_dir))
    return counts.largest(found, "event_count", "event_type")


# --- marts over events -------------------------------------------------------------------


@query
def top_repos(spark, sf_dir):
    return marts.top_repos(views.events(spark, sf_dir), JANUARY)


@query
def top_repos_from_raw(spark, sf_dir):
    """The flagship: JSON lines in, mart out."""
    base = events.events_base(views.raw_lines(spark, sf_dir))
    return marts.top_repos(base, JANUARY)


@query
def top_event_types(spark, sf_dir):
    return marts.top_event_types(views.events(spark, sf_dir), JANUARY)


@query
def top_actors(spark, sf_dir):
    return marts.top_actors(views.events(spark, sf_dir), JANUARY)


@query
def top_actors_distinct_repo(spark, sf_dir):
    return marts.top_actors(views.events(spark, sf_dir), JANUARY, metric="distinct_repo")


@query
def repo_dim(spark, sf_dir):
    return marts.repo_dim(top_repos(spark, sf_dir))


@query
def actor_dim(spark, sf_dir):
    return marts.actor_dim(top_actors(spark, sf_dir))


@query
def top_repo_event_types(spark, sf_dir):
    base = views.events(spark, sf_dir)
    return marts.top_repo_event_types(base, marts.top_repos(base, JANUARY), JANUARY)


@query
def top_actor_event_types(spark, sf_dir):
    base = views.events(spark, sf_dir)
    return marts.top_actor_event_types(base, marts.top_actors(base, JANUARY), JANUARY)


@query
def top_actor_event_types_distinct_repo(spark, sf_dir):
    base, metric = views.events(spark, sf_dir), "distinct_repo"
    top = marts.top_actors(base, JANUARY, metric=metric)
    return marts.top_actor_event_types(base, top, JANUARY, metric=metric)


@query
def daily_top_repos(spark, sf_dir):
    return marts.daily_top_repos(views.events(spark, sf_dir), JANUARY)


@query
def push_branch_groups(spark, sf_dir):
    return pushes.branch_counts(views.pushes(spark, sf_dir))


@query
def push_branch_ratio(spark, sf_dir):
    return rounded(marts.push_branch_ratio(views.pushes(spark, sf_dir), JANUARY))


# --- raw lines to silver -----------------------------------------------------------------


@query
def bronze_lines(spark, sf_dir):
    """The archive's lines as gzip text at rest, scanned with their source file."""
    path = scratch_path(spark, "bronze")
    lines = views.raw_lines(spark, sf_dir).select("raw_json")
    lines.write.option("compression", "gzip").text(path)
    scanned = bronze.read_lines(spark, f"{path}/*.gz")
    return scanned.select("raw_json", F.col("source_file").endswith(".gz").alias("has_source"))


@query
def bronze_day(spark, sf_dir):
    """A day's folder out of two that have landed, with the folder each line came from."""
    path, lines = scratch_path(spark, "bronze-days"), views.raw_lines(spark, sf_dir)
    for day in (DRIFT_DAY - dt.timedelta(days=1), DRIFT_DAY):
        own = lines.where(F.col("source_file").startswith(f"archive/{day:%Y/%m/%d}/"))
        own.select("raw_json").write.option("compression", "gzip").text(f"{path}/{day:%Y/%m/%d}")
    scanned = bronze.read_day(spark, path, DRIFT_DAY, "*.gz")
    folder = F.regexp_extract("source_file", r"(\d{4}/\d{2}/\d{2})/[^/]+\.gz$", 1)
    return scanned.select("raw_json", folder.alias("folder"))


@query
def bronze_hour(spark, sf_dir):
    """The first hour's file that has landed for the drift day, by its name."""
    root = views.landed_archive(spark, sf_dir)
    landed = bronze.landed_files(spark, root, DRIFT_DAY, DRIFT_DAY)
    hours = F.regexp_extract("source_name", r"-(\d+)\.json", 1).cast("int")
    first = landed.agg(F.min(hours)).first()[0]
    scanned = bronze.read_hour(spark, root, dt.datetime.combine(DRIFT_DAY, dt.time(first)))
    name = F.element_at(F.split("source_file", "/"), -1)
    return scanned.select("raw_json", name.alias("source_name"))


@query
def envelope_parse(spark, sf_dir):
    parsed = events.parse_lines(views.raw_lines(spark, sf_dir))
    return events.readable_events(parsed).select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        "created_at",
        F.col("payload").alias("payload_raw"),
        F.col(f"{events.CORRUPT}").isNotNull().alias("is_corrupt"),
    )


@query
def invalid_rows(spark, sf_dir):
    return events.quarantine(events.parse_lines(views.raw_lines(spark, sf_dir)))


@query
def invalid_sample(spark, sf_dir):
    return events.quarantine_sample(events.parse_lines(views.raw_lines(spark, sf_dir)))


@query
def events_normalized(spark, sf_dir):
    readable = events.readable_events(events.parse_lines(views.raw_lines(spark, sf_dir)))
    return rounded(
        events.normalize(readable).select(
            F.col("id").alias("event_id"), "created_at", "created_at_ts", "dt"
        )
    )


@query
def events_base(spark, sf_dir):
    return rounded(events.events_base(views.raw_lines(spark, sf_dir)))


@query
def events_base_own_day(spark, sf_dir):
    base = events.on_own_day(events.events_base(views.raw_lines(spark, sf_dir)))
    return base.select("event_id", "dt", "source_file")


def _track_query(name: str) -> None:
    def run(spark, sf_dir):
        base = events.events_base(views.raw_lines(spark, sf_dir))
        table = tracks.track(base, name)
        if "pages" in table.columns:
            table = table.withColumn("pages", F.to_json("pages"))
        return rounded(table)

    run.__name__ = f"track_{name.removeprefix('events_')}"
    query(run)


for _name in tracks.TRACKS:
    _track_query(_name)


@query
def payload_variant(spark, sf_dir):
    observed = tracks.observed_payloads(views.base_table(spark, sf_dir))
    return observed.groupBy("track", "payload_variant").agg(F.sum("times").alias("rows"))


@query
def type_profile(spark, sf_dir):
    return profile.type_profile(events.events_base(views.raw_lines(spark, sf_dir)))


@query
def track_profile(spark, sf_dir):
    base = events.events_base(views.raw_lines(spark, sf_dir))
    return profile.track_profiles(tracks.observed_payloads(base), tracks.TRACKS)


@query
def day_preview(spark, sf_dir):
    base = events.events_base(views.raw_lines(spark, sf_dir))
    columns = ["dt", "event_id", "event_type", "repo_name", "actor_login", "created_at_ts"]
    shown = base.where(in_days(DRIFT_DAY, DRIFT_DAY))
    return rounded(profile.preview(shown, columns, ["created_at_ts", "event_id"]))


# --- pull requests -----------------------------------------------------------------------


def _pr_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        views.pull_requests(spark, sf_dir),
        views.reviews(spark, sf_dir),
        views.review_comments(spark, sf_dir),
    )


@query
def pr_base(spark, sf_dir):
    return rounded(pull_requests.pull_request_base(views.pull_requests(spark, sf_dir)))


@query
def pr_review_stats(spark, sf_dir):
    return rounded(pull_requests.review_stats(views.reviews(spark, sf_dir)))


@query
def pr_review_comment_stats(spark, sf_dir):
    return rounded(pull_requests.review_comment_stats(views.review_comments(spark, sf_dir)))


@query
def pr_enriched(spark, sf_dir):
    return rounded(latency.enriched_pull_requests(*_pr_tables(spark, sf_dir)))


_PR_KEY = ["repo_name", "pull_request_id"]


@query
def pr_gap_lag(spark, sf_dir):
    windowed = latency.windowed_pull_requests(*_pr_tables(spark, sf_dir), wanted=["opening"])
    return rounded(windowed.select(*_PR_KEY, "prev_opened_at", "pr_gap_hours"))


@query
def pr_rolling(spark, sf_dir):
    windowed = latency.windowed_pull_requests(*_pr_tables(spark, sf_dir), wanted=["opening"])
    return rounded(
        windowed.select(
            *_PR_KEY, "rolling_pr_count_50", "rolling_avg_first_review_hours_50"
        )
    )


_SPEED_COLUMNS = [
    "repo_review_speed_rank",
    "repo_review_speed_percent_rank",
    "daily_review_speed_rank",
]


@query
def pr_speed_rank(spark, sf_dir):
    windowed = latency.windowed_pull_requests(*_pr_tables(spark, sf_dir), wanted=["speed"])
    return rounded(windowed.select(*_PR_KEY, *_SPEED_COLUMNS))


@query
def pr_windows_split(spark, sf_dir):
    windowed = latency.windowed_pull_requests(*_pr_tables(spark, sf_dir), SLICE_ROWS)
    return rounded(
        windowed.select(
            *_PR_KEY,
            "pr_gap_hours",
            "rolling_pr_count_50",
            "rolling_avg_first_review_hours_50",
            *_SPEED_COLUMNS,
        )
    )


@query
def pr_review_latency(spark, sf_dir):
    return rounded(
        marts.pull_request_review_latency(*_pr_tables(spark, sf_dir), ALL_ORDERS)
    )


@query
def pr_review_latency_split(spark, sf_dir):
    return rounded(
        marts.pull_request_review_latency(*_pr_tables(spark, sf_dir), ALL_ORDERS, SLICE_ROWS)
    )


# --- drift -------------------------------------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = views.base_table(spark, sf_dir)
    return drift.shape_profile(
        tracks.observed_payloads(base, drift.CHECKED_TRACKS), "times"
    )


def _before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The registry that the days before the drift day leave, and the variants from it on."""
    variants = drift.variant_counts(materialize(_profile(spark, sf_dir), "drift-profile"))
    before = drift.first_seen(variants.where(F.col("dt") < DRIFT_DAY))
    return before, variants.where(F.col("dt") >= DRIFT_DAY)


@query
def drift_parse_rate(spark, sf_dir):
    return rounded(drift.parse_health(_profile(spark, sf_dir)))


@query
def drift_variants(spark, sf_dir):
    return drift.variant_counts(_profile(spark, sf_dir))


@query
def drift_new(spark, sf_dir):
    registry, current = _before_and_after(spark, sf_dir)
    return drift.new_variants(current, registry)


@query
def drift_new_global(spark, sf_dir):
    registry, current = _before_and_after(spark, sf_dir)
    return drift.new_variants(current, registry, "global")


@query
def drift_labels(spark, sf_dir):
    registry, current = _before_and_after(spark, sf_dir)
    return drift.label_variants(current, registry)


@query
def drift_known(spark, sf_dir):
    registry, current = _before_and_after(spark, sf_dir)
    return drift.known_variants(current, registry)


@query
def registry_merge(spark, sf_dir):
    registry, current = _before_and_after(spark, sf_dir)
    return drift.merge_registry(registry, drift.new_variants(current, registry))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days at once, each judged against the days before it."""
    profile = materialize(_profile(spark, sf_dir), "drift-profile")
    return drift.track_verdicts(
        drift.expected_tracks(profile.select("dt").distinct()),
        drift.parse_health(profile),
        drift.label_first_seen(drift.variant_counts(profile)),
    )


@query
def drift_tracks(spark, sf_dir):
    verdicts = _verdicts(spark, sf_dir)
    return rounded(
        verdicts.withColumn("drift_reasons", F.array_join("drift_reasons", "; "))
    )


@query
def drift_daily(spark, sf_dir):
    daily = drift.daily_verdicts(_verdicts(spark, sf_dir))
    return rounded(daily.withColumn("affected_tracks", F.array_join("affected_tracks", ",")))


@query
def drift_history(spark, sf_dir):
    daily = drift.daily_verdicts(_verdicts(spark, sf_dir))
    recorded = daily.withColumn("recorded_at", F.col("dt").cast("timestamp"))
    recent = drift.drift_history(recorded)
    return rounded(recent.withColumn("affected_tracks", F.array_join("affected_tracks", ",")))


# --- bookkeeping of landed hours ---------------------------------------------------------


def span(spark: SparkSession, sf_dir: str) -> marts.Days:
    """The first and the last day of the archive's lines."""
    return marts.Days(*views.facts(spark, sf_dir).agg(F.min("dt"), F.max("dt")).first())


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the archive's lines span."""
    ends = views.facts(spark, sf_dir).agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("dt"))


def _landed(lines: DataFrame) -> DataFrame:
    """Landed files with the length of their text; an hour of blank lines is empty."""
    name = F.element_at(F.split("source_file", "/"), -1)
    return lines.groupBy(name.alias("source_name")).agg(
        F.sum(F.length("raw_json")).alias("bytes")
    )


def _landed_before_drift(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("source_name") < rules.DRIFT_DAY)


@query
def hour_manifest(spark, sf_dir):
    return manifest.hour_manifest(_days(spark, sf_dir))


@query
def missing_hours(spark, sf_dir):
    """What is left to fetch once the files up to the drift day have landed."""
    landed = _landed_before_drift(_landed(views.raw_lines(spark, sf_dir)))
    return manifest.missing_hours(manifest.hour_manifest(_days(spark, sf_dir)), landed)


def _statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = _landed(views.raw_lines(spark, sf_dir))
    due = manifest.hour_manifest(_days(spark, sf_dir))
    return manifest.ingest_status(due, _landed_before_drift(after), after)


@query
def ingest_status(spark, sf_dir):
    return _statuses(spark, sf_dir).select("source_name", "bytes", "status")


@query
def ingest_summary(spark, sf_dir):
    return manifest.ingest_summary(_statuses(spark, sf_dir))


def _landed_until(spark: SparkSession, sf_dir: str, last: dt.date) -> DataFrame:
    """What a listing of the archive's folders finds, up to a day."""
    own = span(spark, sf_dir)
    return bronze.landed_files(spark, views.landed_archive(spark, sf_dir), own.start, last)


@query
def landed_hours(spark, sf_dir):
    """The hourly files as a listing of the landed archive finds them."""
    # A late event's file may lie in the folder of the day behind the span.
    last = span(spark, sf_dir).end + dt.timedelta(days=1)
    landed = _landed_until(spark, sf_dir, last)
    return landed.select("source_name", (F.col("bytes") > 0).alias("has_bytes"))


@query
def landed_missing_hours(spark, sf_dir):
    """``missing_hours`` by the listing of the days before the drift day."""
    landed = _landed_until(spark, sf_dir, DRIFT_DAY - dt.timedelta(days=1))
    return manifest.missing_hours(manifest.hour_manifest(_days(spark, sf_dir)), landed)


@query
def landed_summary(spark, sf_dir):
    """How an ingest run went that found the days before the drift day and landed the rest."""
    before = _landed_until(spark, sf_dir, DRIFT_DAY - dt.timedelta(days=1))
    after = _landed_until(spark, sf_dir, span(spark, sf_dir).end)
    due = manifest.hour_manifest(_days(spark, sf_dir))
    return manifest.ingest_summary(manifest.ingest_status(due, before, after))


# --- the jobs, over tables at rest -------------------------------------------------------

_silver: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}
_tracks_due: dict[tuple[str, str], list[str]] = {}
_gold: set[tuple[str, str]] = set()
# The tracks that the gold job reads.
_GOLD_TRACKS = [name for name in tracks.TRACKS if name in silver.MART_COLUMNS]


def _silver_lake(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """A lake with silver of the whole archive and the job's line counts, built once per session.

    Where gold queries have begun it, the tracks that they did not need are added.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _silver:
        lake = scratch_path(spark, "lake")
        report = jobs.load_silver(views.raw_lines(spark, sf_dir), lake, span(spark, sf_dir))
        _silver[key] = lake, report
    elif key in _tracks_due:
        jobs.write_tracks(spark, _silver[key][0], span(spark, sf_dir), _tracks_due[key])
        del _tracks_due[key]
    return _silver[key]


def _gold_lake(spark: SparkSession, sf_dir: str) -> str:
    """The same lake with gold of its silver, for the queries that read marts.

    Of silver it needs the base table, whole, and the tracks that the gold job reads.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _silver:
        lake, days = scratch_path(spark, "lake"), span(spark, sf_dir)
        report = jobs.load_base(views.raw_lines(spark, sf_dir), lake, days)
        jobs.write_tracks(spark, lake, days, _GOLD_TRACKS)
        _silver[key] = lake, report
        _tracks_due[key] = [name for name in tracks.TRACKS if name not in _GOLD_TRACKS]
    lake, _ = _silver[key]
    if key not in _gold:
        jobs.run_gold(spark, lake, span(spark, sf_dir))
        _gold.add(key)
    return lake


@query
def silver_report(spark, sf_dir):
    """The job's own line counts, which it gathers over all lines while it writes."""
    _, report = _silver_lake(spark, sf_dir)
    return spark.createDataFrame(list(report.items()), "measure string, lines long")


@query
def silver_rows(spark, sf_dir):
    """The audit's rows per dataset and day, with whether files and bytes were found."""
    audit = jobs.silver_audit(spark, _silver_lake(spark, sf_dir)[0], span(spark, sf_dir))
    return audit.where("NOT missing").select(
        "dataset",
        "dt",
        "rows",
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query
def output_audit(spark, sf_dir):
    """The audit of all days and one more on either side; sizes depend on the writer."""
    own, day = span(spark, sf_dir), dt.timedelta(days=1)
    audit = jobs.silver_audit(
        spark, _silver_lake(spark, sf_dir)[0], marts.Days(own.start - day, own.end + day)
    )
    return audit.select(
        "dataset",
        "dt",
        "rows",
        "missing",
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") > 0).alias("has_bytes"),
    )


@query
def silver_days(spark, sf_dir):
    """Three days of the base table, read from their folders, with the columns of the marts."""
    root = jobs.silver_root(_silver_lake(spark, sf_dir)[0])
    last = DRIFT_DAY + dt.timedelta(days=1)
    return silver.read_for_marts(spark, root, silver.BASE, DRIFT_DAY - dt.timedelta(days=1), last)


@query
def silver_track_day(spark, sf_dir):
    """One day of a track, as the drift check reads it."""
    root = jobs.silver_root(_silver_lake(spark, sf_dir)[0])
    day = silver.read_day_or_empty(spark, root, "events_push", DRIFT_DAY)
    return day.select("dt", "event_id", "repo_name", "payload_variant", "commit_count")


def _gold_query(name: str) -> None:
    def run(spark, sf_dir):
        lake = _gold_lake(spark, sf_dir)
        path = f"{jobs.gold_root(lake)}/{name}"
        if name in ("daily_top_repos", "push_branch_ratio", "pull_request_review_latency"):
            return rounded(spark.read.parquet(path))
        return rounded(gold.read_mart(spark, path))

    run.__name__ = f"gold_{name}"
    query(run)


for _name in (
    "top_repos",
    "event_type_counts",
    "top_repo_event_types",
    "top_actors",
    "top_actor_event_types",
    "daily_top_repos",
    "push_branch_ratio",
    "pull_request_review_latency",
):
    _gold_query(_name)


@query
def gold_csv_top_repos(spark, sf_dir):
    """A mart written as CSV with a header, read back by its declared columns."""
    lake = _gold_lake(spark, sf_dir)
    mart = gold.read_mart(spark, f"{jobs.gold_root(lake)}/top_repos")
    path = scratch_path(spark, "gold-csv")
    gold.write_mart(mart, path, "csv")
    return gold.read_mart(spark, path, "csv", mart.schema)


def _two_drift_runs(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The day before the drift day fills the registry, the drift day is judged.

    Where the metadata is, and the verdicts. The registry is its own, so that a query gives
    the same rows every time.
    """
    target, source = scratch_path(spark, "drift"), jobs.silver_root(_silver_lake(spark, sf_dir)[0])
    jobs.run_drift(spark, target, DRIFT_DAY - dt.timedelta(days=1), silver_source=source)
    verdicts = jobs.run_drift(spark, target, DRIFT_DAY, silver_source=source)
    return jobs.metadata_root(target), verdicts


@query
def drift_job(spark, sf_dir):
    _, verdicts = _two_drift_runs(spark, sf_dir)
    return rounded(
        verdicts.withColumn("drift_reasons", F.array_join("drift_reasons", "; "))
    )


_DAILY = ["dt", "drift_detected", "total_new_variants", "max_failure_rate"]


@query
def drift_job_results(spark, sf_dir):
    """The stored document of the drift day."""
    root, _ = _two_drift_runs(spark, sf_dir)
    stored = spark.read.json(f"{root}/drift_results").withColumnRenamed("target_date", "dt")
    return rounded(
        stored.where(F.col("dt") == F.lit(DRIFT_DAY)).select(
            *_DAILY,
            F.array_join("affected_tracks", ",").alias("affected_tracks"),
            F.size("track_results").cast("long").alias("tracks"),
        )
    )


@query
def drift_job_history(spark, sf_dir):
    """The history that the two runs have left: its entry of the drift day."""
    root, _ = _two_drift_runs(spark, sf_dir)
    entry = metadata.read_history(spark, root).where(F.col("dt") == F.lit(DRIFT_DAY))
    tracks = F.array_join("affected_tracks", ",").alias("affected_tracks")
    return rounded(entry.select(*_DAILY, tracks, F.col("recorded_at").isNotNull().alias("recorded")))


@query
def drift_job_registry(spark, sf_dir):
    root, _ = _two_drift_runs(spark, sf_dir)
    registry, version = metadata.read_registry(spark, root)
    return registry.select(
        "track", "payload_variant", "first_seen_dt", F.lit(version).cast("long").alias("version")
    )
