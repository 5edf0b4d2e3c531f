"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The archive's time format and the fingerprint sentinels.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssX"
PARSE_FAIL = "parse_fail"
NO_PAYLOAD = "no_payload"


def event_time(text: Column | str) -> Column:
    """Archive time text as a timestamp; NULL for any other format, under ANSI mode too."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(EVENT_TIME_FORMAT))


def hours_between(earlier: Column | str, later: Column | str) -> Column:
    """Elapsed hours in whole seconds / 3600; negative when ``later`` comes first."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(3600.0)


def payload_fingerprint(payload: Column | str) -> Column:
    """SHA-256 of the sorted, comma-joined top-level keys of a JSON object.

    Keys nested deeper do not count. Anything that is not a JSON object gives the
    ``parse_fail`` sentinel.
    """
    keys = F.sort_array(F.array_distinct(F.json_object_keys(payload)))
    return F.coalesce(F.sha2(F.array_join(keys, ","), 256), F.lit(PARSE_FAIL))


def branch_group(ref: Column | str) -> Column:
    """``main`` / ``master`` / ``other`` of a pushed ref, ``unknown`` without one.

    Only a leading ``refs/heads/`` is taken off, so a tag counts as ``other`` and a
    bare ``main`` as ``main``.
    """
    branch = F.regexp_replace(ref, "^refs/heads/", "")
    named = F.when(branch.isin("main", "master"), branch).otherwise("other")
    return F.when(branch.isNull(), "unknown").otherwise(named)


def in_days(start: dt.date, end: dt.date, day: str = "dt") -> Column:
    """Inclusive day range on a date column; a literal range, so partitions are pruned."""
    return F.col(day).between(F.lit(start), F.lit(end))


def date_range_stamp(start: dt.date, end: dt.date) -> dict[str, Column]:
    """The ``start_dt`` / ``end_dt`` columns that say which days a mart covers."""
    return {"start_dt": F.lit(start), "end_dt": F.lit(end)}
