"""Typed tracks: golden rows, fingerprints, payloads that fit badly."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strata.functions.columns import payload_fingerprint
from strata.functions.schemas import EVENTS_BASE
from strata.operators.drift import observations, shape_profile
from strata.operators.tracks import SHARED_COLUMNS, TRACKS, all_tracks, observed_payloads, track


def base(spark, event_type, *payloads):
    rows = [
        (str(i), event_type, p if p is None or isinstance(p, str) else json.dumps(p))
        for i, p in enumerate(payloads)
    ]
    df = spark.createDataFrame(rows, "event_id string, event_type string, payload_raw string")
    missing = [f for f in EVENTS_BASE if f.name not in df.columns]
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return df.select(EVENTS_BASE.fieldNames())


def rows(spark, name, *payloads):
    found = track(base(spark, TRACKS[name].event_type, *payloads), name)
    return found.orderBy("event_id").collect()


def sha(keys):
    return hashlib.sha256(keys.encode()).hexdigest()


@pytest.mark.parametrize(
    "payload, expected",
    [
        ('{"b":1,"a":{"z":1}}', sha("a,b")),
        ('{"a":1,"b":2}', sha("a,b")),
        ('{"a":1,"a":2}', sha("a")),
        ('{"a,b":1}', sha("a,b")),  # the hash of two keys: a known collision
        ("{}", sha("")),
        ("[1]", "parse_fail"),
        ("5", "parse_fail"),
        ('"x"', "parse_fail"),
        ('{"a":1', "parse_fail"),
        ("", "parse_fail"),
        (None, "parse_fail"),
    ],
)
def test_fingerprint(spark, payload, expected):
    df = spark.createDataFrame([(payload,)], "p string")
    assert df.select(payload_fingerprint("p")).first()[0] == expected


PUSH_OLD = {
    "repository_id": 1,
    "push_id": 2,
    "size": 3,
    "distinct_size": 2,
    "ref": "refs/heads/main",
    "head": "h",
    "before": "b",
    "commits": [
        {"sha": "s1", "author": {"email": "e", "name": "n"}, "message": "m", "distinct": True,
         "url": "u"},
        {"sha": None, "message": "no sha"},
        {"sha": "s2"},
    ],
}
PUSH_NEW = {"repository_id": 1, "push_id": 5, "ref": None, "head": "h", "before": "b"}


def test_push_before_and_after_the_shape_change(spark):
    old, new, empty = rows(spark, "events_push", PUSH_OLD, PUSH_NEW, {"commits": []})
    assert (old.push_size, old.push_distinct_size, old.commit_count) == (3, 2, 3)
    assert (new.push_size, new.push_distinct_size, new.commit_count) == (0, 0, 0)
    assert (old.ref, new.ref, empty.commit_count) == ("refs/heads/main", None, 0)
    assert old.payload_parse_ok and new.payload_parse_ok
    assert old.payload_variant == sha(
        "before,commits,distinct_size,head,push_id,ref,repository_id,size"
    )
    assert new.payload_variant == sha("before,head,push_id,ref,repository_id")


def test_push_commits_one_row_per_commit_with_a_sha(spark):
    first, second = sorted(
        rows(spark, "push_commits", PUSH_OLD, PUSH_NEW, {"commits": []}),
        key=lambda r: r.commit_sha,
    )
    assert (first.commit_sha, first.commit_author_email, first.commit_author_name) == (
        "s1", "e", "n",
    )
    assert (first.commit_message, first.commit_distinct, first.commit_url) == ("m", True, "u")
    assert (second.commit_sha, second.commit_author_name, second.push_size) == ("s2", None, 3)
    (unsized,) = rows(spark, "push_commits", {"commits": [{"sha": "x"}]})
    assert (unsized.push_size, unsized.push_distinct_size) == (None, None)


def test_pull_request_number_from_either_place(spark):
    outer, inner = rows(
        spark,
        "events_pull_request",
        {"action": "opened", "number": 5, "pull_request": {"id": 1, "number": 6}},
        {"action": "opened", "pull_request": {"id": 1, "number": 6, "commits": 4,
         "base": {"ref": "main", "repo": {"full_name": "o/r"}}}},
    )
    assert (outer.pull_request_number, inner.pull_request_number) == (5, 6)
    assert (inner.base_ref, inner.base_repo_full_name, inner.head_ref) == ("main", "o/r", None)
    assert inner.commit_count == 4


def test_wiki_pages_stay_nested(spark):
    pages = [{"page_name": "p", "title": "t", "action": "edited", "sha": "s"}]
    some, none, absent = rows(spark, "events_gollum", {"pages": pages}, {"pages": []}, {})
    assert (some.page_count, none.page_count, absent.page_count) == (1, 0, None)
    assert some.pages[0].title == "t"


def test_public_events_have_no_payload(spark):
    (row,) = rows(spark, "events_public", None)
    assert (row.payload_parse_ok, row.payload_corrupt, row.payload_variant) == (
        True, False, "no_payload",
    )


@pytest.mark.parametrize(
    "payload, ok, corrupt, ref",
    [
        ('{"ref":"a","ref_type":"branch"}', True, False, "a"),
        ("{}", True, False, None),
        (None, False, False, None),
        ("", False, False, None),
        ('{"ref":"a"', True, True, None),
        ("[1]", True, True, None),
    ],
)
def test_parse_flags(spark, payload, ok, corrupt, ref):
    (row,) = rows(spark, "events_create", payload)
    assert (row.payload_parse_ok, row.payload_corrupt, row.ref) == (ok, corrupt, ref)


def test_wrong_type_is_flagged_and_the_other_fields_stay(spark):
    (row,) = rows(spark, "events_push", {"push_id": "text", "ref": "r"})
    assert (row.push_id, row.ref, row.payload_parse_ok, row.payload_corrupt) == (
        None, "r", True, True,
    )


def test_every_track_selects_its_type_and_columns(spark):
    assert len(TRACKS) == 17
    events = base(spark, "PushEvent", {}).unionByName(base(spark, "ForkEvent", {}))
    for name, table in all_tracks(events).items():
        spec = TRACKS[name]
        flags = ["payload_parse_ok", "payload_corrupt", "payload_variant"]
        assert table.columns == [*SHARED_COLUMNS, *flags, *spec.columns]
    assert track(events, "events_fork").count() == 1
    assert track(events, "events_watch").count() == 0


@pytest.mark.parametrize("name", TRACKS)
def test_each_payload_is_parsed_once(spark, name):
    """Also where few columns are read, or counted: filters must not repeat the parse."""
    table = track(base(spark, TRACKS[name].event_type, {}), name)
    typed = [c for c in table.columns if c not in SHARED_COLUMNS]
    few = [table, table.select("dt", typed[-1]), table.groupBy("payload_parse_ok").count()]
    for df in few:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") <= 1


def test_observed_payloads_are_the_tracks_rows(spark):
    events = [base(spark, t, {"ref": "x", "size": "bad"}, "{", None, {"commits": [{"sha": "a"}, {"sha": "b"}, {}]})
              for t in ("PushEvent", "WatchEvent", "PublicEvent", "NoSuchEvent")]
    together = events[0].union(events[1]).union(events[2]).union(events[3])
    observed = observed_payloads(together)
    wanted = shape_profile(observations(all_tracks(together)))
    assert sorted(map(tuple, shape_profile(observed, "times").collect()), key=repr) == sorted(
        map(tuple, wanted.collect()), key=repr
    )
    plan = observed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 4  # one scan of each input
