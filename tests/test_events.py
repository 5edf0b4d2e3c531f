"""Raw lines to base events: every trap of the input, with exact expected rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from strata.functions.schemas import EVENTS_BASE
from strata.operators import events

GOOD = {
    "id": "1",
    "type": "WatchEvent",
    "actor": {"id": 7, "login": "ann", "display_login": "Ann"},
    "repo": {"id": 9, "name": "ann/x", "url": "u"},
    "payload": {"action": "started"},
    "public": True,
    "created_at": "2024-01-01T10:00:00Z",
}


def line(**changes):
    fields = {**GOOD, **changes}
    return json.dumps({k: v for k, v in fields.items() if v is not ...}, separators=(",", ":"))


def raw(spark, *lines):
    return spark.createDataFrame([(text, "2024-01-01-10.json.gz") for text in lines],
                                 "raw_json string, source_file string")


def base(spark, *lines):
    return events.events_base(raw(spark, *lines)).collect()


@pytest.mark.parametrize(
    "text, fault",
    [
        ("", "blank"),
        ("   ", "blank"),
        ("{bad", "malformed"),
        ("[1]", "malformed"),
        ("5", "malformed"),
        (line()[:60], "malformed"),
        (line(), None),
        (line() + " trailing", None),
        (line(actor={"id": "text", "login": "ann"}), None),
        ("{}", None),
    ],
)
def test_fault_of_a_line(spark, text, fault):
    (row,) = events.parse_lines(raw(spark, text)).collect()
    assert row.fault == fault


def test_quarantine_keeps_the_text(spark):
    parsed = events.parse_lines(raw(spark, line(), "{bad", ""))
    found = {(r.raw_json, r.fault) for r in events.quarantine(parsed).collect()}
    assert found == {("{bad", "malformed"), ("", "blank")}
    assert events.quarantine_sample(parsed, 1).collect()[0].raw_json == ""
    assert events.readable_events(parsed).count() == 1


def test_base_columns_and_values(spark):
    df = events.events_base(raw(spark, line()))
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in EVENTS_BASE]
    (row,) = df.collect()
    assert row.dt == dt.date(2024, 1, 1)
    assert (row.event_id, row.event_type) == ("1", "WatchEvent")
    assert (row.actor_id, row.actor_login, row.actor_display_login) == (7, "ann", "Ann")
    assert (row.repo_id, row.repo_name, row.org_id, row.public) == (9, "ann/x", None, True)
    assert row.payload_raw == '{"action":"started"}'


@pytest.mark.parametrize(
    "created_at",
    ["2024-01-01", "2024-01-01T10:00:00+09:00", "2024-01-01T10:00:00.5Z", "soon", None, ...],
)
def test_unreadable_time_drops_the_event(spark, created_at):
    assert base(spark, line(created_at=created_at)) == []


def test_short_offset_is_a_time(spark):
    (row,) = base(spark, line(created_at="2024-01-01T10:00:00+09"))
    assert row.dt == dt.date(2024, 1, 1)
    (row,) = base(spark, line(created_at="2024-01-01T01:00:00+09"))
    assert row.dt == dt.date(2023, 12, 31)


@pytest.mark.parametrize("missing", ["id", "type"])
def test_missing_identity_drops_the_event(spark, missing):
    assert base(spark, line(**{missing: ...})) == []
    assert base(spark, line(**{missing: None})) == []


def test_numeric_id_becomes_text(spark):
    assert base(spark, line(id=42))[0].event_id == "42"


def test_wrong_typed_field_is_null_and_the_row_stays(spark):
    (row,) = base(spark, line(actor={"id": "text", "login": "ann"}))
    assert (row.actor_id, row.actor_login) == (None, "ann")


@pytest.mark.parametrize(
    "payload, text",
    [
        ({"a": [1, {"b": None}], "c": "é"}, '{"a":[1,{"b":null}],"c":"é"}'),
        ({}, "{}"),
        (None, None),
        (..., None),
        ("word", "word"),
        ([1, 2], "[1,2]"),
    ],
)
def test_payload_is_kept_as_get_json_object_gives_it(spark, payload, text):
    lines = raw(spark, line(payload=payload))
    (row,) = events.events_base(lines).collect()
    (direct,) = lines.select(F.get_json_object("raw_json", "$.payload").alias("p")).collect()
    assert row.payload_raw == direct.p == text


def test_events_of_another_day_than_their_file_are_dropped(spark):
    df = spark.createDataFrame(
        [
            (line(id="a"), "s3://x/2024/01/01/2024-01-01-7.json.gz"),
            (line(id="b"), "file:/x/2024/01/02/2024-01-02-0.json.gz"),
        ],
        "raw_json string, source_file string",
    )
    kept = events.on_own_day(events.events_base(df)).collect()
    assert [r.event_id for r in kept] == ["a"]


def test_each_line_is_parsed_once(spark):
    plan = events.events_base(raw(spark, line()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
