"""Payload shape drift: parse failures and unknown variants per track and day.

All tracks go through one plan. Only verdict rows, one per track and day, are ever small
by construction; lists of variants stay rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import PARSE_FAIL

# Tracks checked by default and the thresholds of the verdict.
CHECKED_TRACKS = [
    "events_push",
    "events_pull_request",
    "events_issues",
    "events_issue_comment",
    "events_pull_request_review",
    "events_create",
    "events_fork",
    "events_watch",
]
FAILURE_RATE_THRESHOLD = 0.05
NEW_VARIANT_THRESHOLD = 1
HISTORY_ROWS = 100
SAMPLE_VARIANTS = 3

TRACK_DAY = ["track", "dt"]


def observations(tracks: Mapping[str, DataFrame]) -> DataFrame:
    """The columns of each track that drift is judged by, as one frame."""
    parts = [
        df.select(
            F.lit(name).alias("track"),
            "dt",
            "payload_parse_ok",
            "payload_corrupt",
            "payload_variant",
        )
        for name, df in tracks.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def expected_tracks(days: DataFrame, tracks: Sequence[str] = CHECKED_TRACKS) -> DataFrame:
    """Every (track, day) that is to be judged, whether or not it has rows."""
    return days.select("dt", F.explode(F.array(*map(F.lit, tracks))).alias("track"))


def shape_profile(observed: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows, parse failures and misfitting payloads per track, day and variant.

    The only pass over the tracks' rows; everything else here derives from this table. An
    observation may stand for several equal rows: ``weight`` is then the column with how many.
    """
    times = F.lit(1).cast("long") if weight is None else F.col(weight)

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, times).otherwise(F.lit(0).cast("long")))

    return observed.groupBy(*TRACK_DAY, "payload_variant").agg(
        F.sum(times).alias("rows"),
        rows(~F.col("payload_parse_ok")).alias("failures"),
        rows(F.col("payload_corrupt")).alias("corrupt"),
    )


def parse_health(profile: DataFrame) -> DataFrame:
    """Rows, parse failures, misfitting payloads and failure rate per track and day."""
    health = profile.groupBy(TRACK_DAY).agg(
        F.sum("rows").alias("total_records"),
        F.sum("failures").alias("parse_failure_count"),
        F.sum("corrupt").alias("corrupt_count"),
    )
    rate = F.col("parse_failure_count") / F.col("total_records")
    return health.withColumn("parse_failure_rate", rate)


def variant_counts(profile: DataFrame) -> DataFrame:
    """Rows per track, day and payload variant; failures have no variant."""
    seen = profile.where(F.col("payload_variant") != PARSE_FAIL)
    return seen.select(*TRACK_DAY, "payload_variant", F.col("rows").alias("variant_rows"))


def _registry_key(scope: str) -> list[str]:
    """A variant is known per track, or ``global``ly, when any track has shown it."""
    return {"track": ["track", "payload_variant"], "global": ["payload_variant"]}[scope]


def new_variants(variants: DataFrame, registry: DataFrame, scope: str = "track") -> DataFrame:
    return variants.join(registry, _registry_key(scope), "left_anti")


def known_variants(variants: DataFrame, registry: DataFrame, scope: str = "track") -> DataFrame:
    return variants.join(registry, _registry_key(scope), "left_semi")


def first_seen(variants: DataFrame, scope: str = "track") -> DataFrame:
    """The registry that a set of days amounts to: each variant with the day it first came."""
    firsts = variants.groupBy(*_registry_key(scope)).agg(F.min("dt").alias("first_seen_dt"))
    return firsts if scope == "track" else firsts.withColumn("track", F.lit(None).cast("string"))


def merge_registry(registry: DataFrame, new: DataFrame, scope: str = "track") -> DataFrame:
    """Known and new variants, once each, with the earliest day."""
    columns = ["track", "payload_variant", "first_seen_dt"]
    both = registry.select(columns).unionByName(first_seen(new, scope).select(columns))
    return both.groupBy("track", "payload_variant").agg(
        F.min("first_seen_dt").alias("first_seen_dt")
    )


def label_variants(variants: DataFrame, registry: DataFrame, scope: str = "track") -> DataFrame:
    """All variants of the day, told apart by ``is_new``."""
    key = _registry_key(scope)
    listed = registry.select(*key, F.lit(False).alias("unlisted")).dropDuplicates(key)
    labelled = variants.join(listed, key, "left")
    is_new = F.coalesce("unlisted", F.lit(True))
    return labelled.select(*variants.columns, is_new.alias("is_new"))


def label_first_seen(variants: DataFrame) -> DataFrame:
    """The variants of many days, new on the day of their first row and known later.

    That is what day-by-day runs from an empty registry find, since each registers what
    it has seen. A window holds one row per day of one variant.
    """
    first = F.min("dt").over(Window.partitionBy("track", "payload_variant"))
    return variants.withColumn("is_new", F.col("dt") == first)


def _variant_summary(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy(TRACK_DAY).agg(
        F.count_if("is_new").alias("new_variant_count"),
        F.count_if(~F.col("is_new")).alias("known_variant_count"),
    )


def _variant_sample(labelled: DataFrame) -> DataFrame:
    """The first few new variants per track and day; ranked first, so the list is short."""
    by_name = Window.partitionBy(TRACK_DAY).orderBy("payload_variant")
    few = (
        labelled.where("is_new")
        .withColumn("n", F.row_number().over(by_name))
        .where(F.col("n") <= SAMPLE_VARIANTS)
    )
    return few.groupBy(TRACK_DAY).agg(
        F.array_sort(F.collect_list("payload_variant")).alias("sample_variants")
    )


def _percent(rate: Column | float) -> Column:
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    return F.format_string("%.2f%%", rate.cast("double") * 100)


def track_verdicts(
    expected: DataFrame,
    health: DataFrame,
    labelled: DataFrame,
    failure_threshold: float = FAILURE_RATE_THRESHOLD,
    new_threshold: int = NEW_VARIANT_THRESHOLD,
) -> DataFrame:
    """One row per expected (track, day): counts, verdict and the reasons for it.

    Drift is a failure rate at or above its threshold, or enough new variants. A track
    without rows that day is reported as such and is not drift.
    """
    counts = ["total_records", "parse_failure_count", "corrupt_count", "parse_failure_rate"]
    counts += ["new_variant_count", "known_variant_count"]
    rows = (
        expected.join(health, TRACK_DAY, "left")
        .join(_variant_summary(labelled), TRACK_DAY, "left")
        .join(_variant_sample(labelled), TRACK_DAY, "left")
        .fillna(0, counts)
    )
    empty = F.col("total_records") == 0
    failing = ~empty & (F.col("parse_failure_rate") >= failure_threshold)
    novel = ~empty & (F.col("new_variant_count") >= new_threshold)
    reasons = F.array_compact(
        F.array(
            F.when(empty, "no data"),
            F.when(
                failing,
                F.concat(
                    F.lit("parse failure rate "),
                    _percent(F.col("parse_failure_rate")),
                    F.lit(" >= threshold "),
                    _percent(failure_threshold),
                ),
            ),
            F.when(
                novel,
                F.concat(
                    F.col("new_variant_count").cast("string"),
                    F.lit(" new variants: "),
                    F.coalesce(F.array_join("sample_variants", ", "), F.lit("")),
                ),
            ),
        )
    )
    return rows.select(
        *TRACK_DAY,
        *counts[:3],
        F.round("parse_failure_rate", 4).alias("parse_failure_rate"),
        *counts[4:],
        (failing | novel).alias("drift_detected"),
        reasons.alias("drift_reasons"),
    )


def daily_verdicts(verdicts: DataFrame) -> DataFrame:
    """The day's roll-up over its tracks; a variant new in two tracks counts twice."""
    drifting = F.when(F.col("drift_detected"), F.col("track"))
    return verdicts.groupBy("dt").agg(
        F.bool_or("drift_detected").alias("drift_detected"),
        F.sum("new_variant_count").alias("total_new_variants"),
        F.max("parse_failure_rate").alias("max_failure_rate"),
        F.array_sort(F.collect_list(drifting)).alias("affected_tracks"),
    )


def drift_history(events: DataFrame, rows: int = HISTORY_ROWS) -> DataFrame:
    """The most recent drift events, newest first."""
    return events.orderBy(F.desc("recorded_at"), F.desc("dt")).limit(rows)
