"""The jobs: bronze to silver, silver to drift report, silver to gold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import in_days
from strata.operators import counts, drift, events, pr_windows, profile
from strata.operators.manifest import days as day_rows
from strata.operators.tracks import TRACKS, track
from strata.plans import marts
from strata.plans.marts import Days
from strata.session import materialize, require_utc, run_together, scratch
from strata.sources import bronze, gold, metadata, silver


# A landed hour is a few hundred megabytes: several row groups per file, sorted by type.
BASE_ROW_GROUP_BYTES = 16 * 1024 * 1024


def silver_root(lake: str) -> str:
    return f"{lake.rstrip('/')}/silver"


def gold_root(lake: str) -> str:
    return f"{lake.rstrip('/')}/gold"


def metadata_root(lake: str) -> str:
    return f"{lake.rstrip('/')}/metadata"


def base_rows(
    lines: DataFrame, days: Days, repartition: int = 0, coalesce: int = 0
) -> tuple[DataFrame, Observation]:
    """The base table's rows of the days as they are written, and the counts of all lines.

    Lines are counted by outcome in the very tasks that write the files: Spark adds up such a
    task once, when it is committed, so the counts stay exact where stages before are
    recomputed after a loss. With ``repartition``, lines that are not kept pass the shuffle as
    well, as short rows.
    """
    judged = events.judged(lines, in_days(days.start, days.end))
    if repartition > 0:
        # Kept apart by type too, so that spreading the rows does not mix the row groups.
        judged = judged.repartition(repartition, "dt", "event_type", F.xxhash64("event_id") % 64)
    elif coalesce > 0:
        judged = judged.coalesce(coalesce)
    seen = Observation("lines by outcome")
    by_outcome = (F.count_if(F.col("outcome") == o).alias(o) for o in events.OUTCOMES)
    counted = judged.observe(seen, F.count(F.lit(1)).alias("lines"), *by_outcome)
    kept = counted.where(F.col("outcome") == events.KEPT).drop("outcome")
    return kept.sortWithinPartitions("dt", "event_type"), seen


def load_base(
    lines: DataFrame,
    lake: str,
    days: Days,
    repartition: int = 0,
    coalesce: int = 0,
) -> dict[str, int]:
    """Raw lines to the base table of the days, and the line counts of ``load_silver``."""
    require_utc(lines.sparkSession)
    base, seen = base_rows(lines, days, repartition, coalesce)
    silver.write_days(base, silver_root(lake), silver.BASE, row_group_bytes=BASE_ROW_GROUP_BYTES)
    return {name: seen.get[name] for name in ("lines", *events.OUTCOMES)}


def write_tracks(
    spark: SparkSession,
    lake: str,
    days: Days,
    names: Iterable[str] = tuple(TRACKS),
    repartition: int = 0,
    coalesce: int = 0,
) -> None:
    """The named tracks of the days, from the base table of the lake."""
    require_utc(spark)
    root = silver_root(lake)
    written = silver.read_days(spark, root, silver.BASE, days.start, days.end)

    def write_track(name: str) -> None:
        table = track(written, name)
        silver.write_days(table, root, name, repartition, coalesce, rebalance=True)

    run_together(partial(write_track, name) for name in names)


def load_silver(
    lines: DataFrame,
    lake: str,
    days: Days,
    repartition: int = 0,
    coalesce: int = 0,
) -> dict[str, int]:
    """Raw lines to the base table and the seventeen tracks of the days.

    The text is parsed once. Base rows are sorted by event type within each file, so a
    track, read back from the base table, skips the row groups of other types; only its
    typed columns are shuffled, into files of a sensible size.

    Returns the line counts of the run: lines, faulty ones, events that normalisation
    dropped, events of another day, events kept.
    """
    counted = load_base(lines, lake, days, repartition, coalesce)
    write_tracks(lines.sparkSession, lake, days, TRACKS, repartition, coalesce)
    return counted


def run_silver(
    spark: SparkSession,
    bronze_root: str,
    lake: str,
    days: Days,
    repartition: int = 0,
    coalesce: int = 0,
) -> dict[str, int]:
    """``load_silver`` of the files that landed for the days."""
    if repartition > 0 and coalesce > 0:
        raise ValueError("repartition and coalesce exclude each other")
    lines = bronze.read_days(spark, bronze_root, days.start, days.end)
    return load_silver(lines, lake, days, repartition, coalesce)


def silver_audit(spark: SparkSession, lake: str, days: Days) -> DataFrame:
    """Files, bytes and rows per dataset and day of the range, and which are missing."""
    names = (silver.BASE, *TRACKS)
    return silver.audit_tables(spark, silver_root(lake), names, days.start, days.end)


def silver_profile(spark: SparkSession, lake: str, days: Days) -> DataFrame:
    """Rows, and rows with a readable payload, of every track over the days."""
    root = silver_root(lake)
    parts = [
        profile.track_profile(silver.read_days(spark, root, name, days.start, days.end)).select(
            F.lit(name).alias("track"), "rows", "payload_ok"
        )
        for name in TRACKS
    ]
    return reduce(DataFrame.unionByName, parts)


def run_drift(
    spark: SparkSession,
    lake: str,
    day: dt.date,
    tracks: list[str] | None = None,
    failure_threshold: float = drift.FAILURE_RATE_THRESHOLD,
    new_threshold: int = drift.NEW_VARIANT_THRESHOLD,
    scope: str = "track",
    silver_source: str | None = None,
) -> DataFrame:
    """Judge one day against the registry, store the verdict, register what is new.

    Silver is read from the lake, or from ``silver_source``. A variant is known if an earlier
    day has shown it, so a rerun of a day comes to the same verdict. The first run finds an
    empty registry and always reports drift. The verdicts come back as they were stored, one
    row for each track.
    """
    require_utc(spark)
    names = tracks or drift.CHECKED_TRACKS
    root = metadata_root(lake)
    source = silver_source or silver_root(lake)
    with scratch(spark, "drift"):
        observed = drift.observations(
            {n: silver.read_day_or_empty(spark, source, n, day) for n in names}
        )
        # Small from here on: one row per track and variant of the day.
        shapes = materialize(drift.shape_profile(observed), "drift-profile")
        variants = drift.variant_counts(shapes)
        registry, _ = metadata.read_registry(spark, root)
        earlier = registry.where(F.col("first_seen_dt") < F.lit(day))
        labelled = drift.label_variants(variants, earlier, scope)
        expected = drift.expected_tracks(day_rows(spark, day, day), names)
        verdicts = materialize(
            drift.track_verdicts(
                expected, drift.parse_health(shapes), labelled, failure_threshold, new_threshold
            ),
            "drift-verdicts",
        )
        daily = drift.daily_verdicts(verdicts)
        metadata.write_results(daily, verdicts, labelled, root)
        metadata.append_history(daily, root)
        new = drift.new_variants(variants, earlier, scope)
        metadata.update_registry(
            spark, root, lambda known: drift.merge_registry(known, new, scope)
        )
        schema = verdicts.schema
    return metadata.read_verdicts(spark, root, day, schema)


def run_gold(
    spark: SparkSession,
    lake: str,
    days: Days,
    top_n: int = 10,
    top_event_types: int = 20,
    daily_top_n: int = 10,
    top_actors: int = 10,
    actor_metric: str = "event_count",
    fmt: str = "parquet",
    files: int = 0,
    slice_rows: int = pr_windows.SLICE_ROWS,
) -> list[str]:
    """All marts over the days; returns the names of those written.

    Marts that count events are built from two rollups, so the base table is scanned
    twice instead of once per mart. The five top-N marts are replaced whole by each run,
    in their order; the daily ones replace their own days only.
    """
    require_utc(spark)
    with scratch(spark, "gold"):
        return _write_marts(
            spark, lake, days, top_n, top_event_types, daily_top_n, top_actors, actor_metric,
            fmt, files, slice_rows,
        )


def _write_marts(
    spark: SparkSession,
    lake: str,
    days: Days,
    top_n: int,
    top_event_types: int,
    daily_top_n: int,
    top_actors: int,
    actor_metric: str,
    fmt: str,
    files: int,
    slice_rows: int,
) -> list[str]:
    source = silver_root(lake)

    def read(dataset: str) -> DataFrame:
        return silver.read_for_marts(spark, source, dataset, days.start, days.end)

    base = read(silver.BASE)
    by_repo = materialize(
        counts.counts_by(base, ["dt", "repo_name", "event_type"], "n"), "repo-rollup"
    )
    by_actor = materialize(
        counts.counts_by(counts.with_actor(base), ["actor_login", "event_type"], "n"),
        "actor-rollup",
    )
    repos = marts.top_repos(by_repo, days, top_n, "n")
    actor_source = base if actor_metric == "distinct_repo" else by_actor
    actors = materialize(
        marts.top_actors(actor_source, days, top_actors, actor_metric, "n"), "top-actors"
    )
    whole = {
        "top_repos": repos,
        "event_type_counts": marts.top_event_types(by_repo, days, top_event_types, "n"),
        "top_repo_event_types": marts.top_repo_event_types(by_repo, repos, days, top_n, "n"),
        "top_actors": actors.orderBy(F.desc(marts.ACTOR_METRICS[actor_metric]), "actor_login"),
        "top_actor_event_types": marts.top_actor_event_types(
            by_actor, actors, days, top_actors, actor_metric, "n"
        ),
    }
    by_day = {
        "daily_top_repos": marts.daily_top_repos(by_repo, days, daily_top_n, "n"),
        "push_branch_ratio": marts.push_branch_ratio(read("events_push"), days),
        "pull_request_review_latency": marts.pull_request_review_latency(
            read("events_pull_request"),
            read("events_pull_request_review"),
            read("events_pull_request_review_comment"),
            days,
            slice_rows,
        ),
    }
    target = gold_root(lake)
    by_day = {name: mart for name, mart in by_day.items() if mart is not None}
    run_together(
        [
            partial(gold.write_mart, mart, f"{target}/{name}", fmt, files)
            for name, mart in whole.items()
        ]
        + [
            partial(gold.write_mart, mart, f"{target}/{name}", fmt, files, "dt")
            for name, mart in by_day.items()
        ]
    )
    return [*whole, *by_day]
