"""Drift verdicts, registry scopes, and the two-day scenario."""

import datetime as dt

import pytest

from strata.operators import drift

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
OBSERVED = (
    "track string, dt date, payload_parse_ok boolean, payload_corrupt boolean, "
    "payload_variant string"
)


def observed(spark, *groups):
    """Groups of (track, day, variant, rows); a variant of parse_fail did not parse."""
    rows = [
        (track, day, variant != "parse_fail", variant.endswith("!"), variant)
        for track, day, variant, n in groups
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, OBSERVED)


def registry(spark, *entries):
    return spark.createDataFrame(
        [(track, variant, D1) for track, variant in entries],
        "track string, payload_variant string, first_seen_dt date",
    )


def judge(spark, seen, known, scope="track", days=(D2,), tracks=("a", "b"), **thresholds):
    profile = drift.shape_profile(seen)
    labelled = drift.label_variants(drift.variant_counts(profile), known, scope)
    days = spark.createDataFrame([(d,) for d in days], "dt date")
    return drift.track_verdicts(
        drift.expected_tracks(days, tracks), drift.parse_health(profile), labelled, **thresholds
    )


def by_track(df):
    return {r.track: r for r in df.collect()}


def test_verdicts_and_reasons(spark):
    seen = observed(
        spark, ("a", D2, "x", 18), ("a", D2, "parse_fail", 2), ("a", D2, "y", 1), ("a", D2, "z!", 1)
    )
    got = by_track(judge(spark, seen, registry(spark, ("a", "x"))))
    a, b = got["a"], got["b"]
    assert (a.total_records, a.parse_failure_count, a.corrupt_count) == (22, 2, 1)
    assert (a.parse_failure_rate, a.new_variant_count, a.known_variant_count) == (0.0909, 2, 1)
    assert a.drift_detected
    assert a.drift_reasons == [
        "parse failure rate 9.09% >= threshold 5.00%",
        "2 new variants: y, z!",
    ]
    assert (b.total_records, b.drift_detected, b.drift_reasons) == (0, False, ["no data"])


def test_thresholds_are_inclusive_and_use_the_unrounded_rate(spark):
    seen = observed(spark, ("a", D2, "x", 19), ("a", D2, "parse_fail", 1))
    known = registry(spark, ("a", "x"))
    assert by_track(judge(spark, seen, known))["a"].drift_detected
    assert not by_track(judge(spark, seen, known, failure_threshold=0.0500001))["a"].drift_detected
    fresh = observed(spark, ("a", D2, "x", 1), ("a", D2, "y", 1))
    assert by_track(judge(spark, fresh, known))["a"].drift_detected
    assert not by_track(judge(spark, fresh, known, new_threshold=2))["a"].drift_detected


def test_no_variants_at_all(spark):
    seen = observed(spark, ("a", D2, "parse_fail", 3))
    row = by_track(judge(spark, seen, registry(spark)))["a"]
    assert (row.new_variant_count, row.parse_failure_rate) == (0, 1.0)


@pytest.mark.parametrize("scope, new", [("track", {("b", "x")}), ("global", set())])
def test_scope_of_the_registry(spark, scope, new):
    variants = drift.variant_counts(
        drift.shape_profile(observed(spark, ("a", D2, "x", 1), ("b", D2, "x", 1)))
    )
    known = registry(spark, ("a", "x"))
    found = drift.new_variants(variants, known, scope).collect()
    assert {(r.track, r.payload_variant) for r in found} == new
    seen = drift.known_variants(variants, known, scope).collect()
    assert {(r.track, r.payload_variant) for r in seen} == {("a", "x"), ("b", "x")} - new
    labels = drift.label_variants(variants, known, scope).collect()
    assert {(r.track, r.payload_variant) for r in labels if r.is_new} == new


def test_many_new_variants_are_counted_whole_and_sampled_short(spark):
    seen = observed(spark, *(("a", D2, f"v{i:03}", 1) for i in range(50)))
    row = by_track(judge(spark, seen, registry(spark)))["a"]
    assert row.new_variant_count == 50
    assert row.drift_reasons == ["50 new variants: v000, v001, v002"]


def test_merge_keeps_the_earliest_day_and_each_variant_once(spark):
    variants = drift.variant_counts(
        drift.shape_profile(
            observed(spark, ("a", D2, "x", 1), ("a", D2, "y", 2), ("b", D2, "y", 1))
        )
    )
    merged = drift.merge_registry(registry(spark, ("a", "x")), variants).collect()
    assert {tuple(r) for r in merged} == {("a", "x", D1), ("a", "y", D2), ("b", "y", D2)}
    assert len(merged) == 3


def test_all_days_at_once_equal_day_by_day_runs(spark):
    seen = observed(
        spark,
        ("a", D1, "x", 2),
        ("b", D1, "p", 1),
        ("a", D2, "x", 1),
        ("a", D2, "y", 1),
        ("b", D2, "p", 1),
    )
    profile = drift.shape_profile(seen)
    days = spark.createDataFrame([(D1,), (D2,)], "dt date")
    at_once = drift.track_verdicts(
        drift.expected_tracks(days, ["a", "b"]),
        drift.parse_health(profile),
        drift.label_first_seen(drift.variant_counts(profile)),
    )
    first = judge(spark, seen.where(f"dt = '{D1}'"), registry(spark), days=(D1,))
    known = registry(spark, ("a", "x"), ("b", "p"))
    second = judge(spark, seen.where(f"dt = '{D2}'"), known)
    assert sorted(map(tuple, at_once.collect())) == sorted(
        map(tuple, first.unionByName(second).collect())
    )


def test_daily_roll_up(spark):
    seen = observed(spark, ("a", D2, "x", 9), ("a", D2, "parse_fail", 1), ("b", D2, "x", 1))
    (row,) = drift.daily_verdicts(judge(spark, seen, registry(spark, ("b", "x")))).collect()
    assert (row.drift_detected, row.total_new_variants, row.max_failure_rate) == (True, 1, 0.1)
    assert row.affected_tracks == ["a"]


def test_history_keeps_the_newest(spark):
    events = spark.range(120).selectExpr(
        "timestamp_seconds(id) AS recorded_at", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS dt"
    )
    kept = drift.drift_history(events).collect()
    assert len(kept) == 100
    assert kept[0].dt == dt.date(2024, 1, 1) + dt.timedelta(119)
