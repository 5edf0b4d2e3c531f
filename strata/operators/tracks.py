"""Base events to the seventeen typed per-event-type tables ("tracks").

Every track is the same narrow plan: filter on the event type, one ``from_json`` of the
payload, projection. The table below holds what differs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import NO_PAYLOAD, payload_fingerprint
from strata.functions.schemas import CORRUPT, PAYLOADS, with_corrupt

# Columns that every track takes over from the base table.
SHARED_COLUMNS = [
    "dt",
    "created_at_ts",
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "actor_display_login",
    "repo_id",
    "repo_name",
    "repo_url",
    "org_id",
    "org_login",
    "public",
    "source_file",
]


@dataclass(frozen=True)
class Track:
    event_type: str
    columns: dict[str, str]  # output column -> expression over ``payload``
    explode: str | None = None  # array to turn into rows, seen by ``columns`` as ``item``
    required: str | None = None  # rows with this column NULL are dropped


# Table name, event type and typed columns of each track.
TRACKS: dict[str, Track] = {
    "events_push": Track(
        "PushEvent",
        {
            "repository_id": "payload.repository_id",
            "push_id": "payload.push_id",
            "ref": "payload.ref",
            "head": "payload.head",
            "before": "payload.before",
            "push_size": "coalesce(payload.size, 0)",
            "push_distinct_size": "coalesce(payload.distinct_size, 0)",
            "commit_count": "coalesce(array_size(payload.commits), 0)",
        },
    ),
    "push_commits": Track(
        "PushEvent",
        {
            "repository_id": "payload.repository_id",
            "push_id": "payload.push_id",
            "push_size": "payload.size",
            "push_distinct_size": "payload.distinct_size",
            "commit_sha": "item.sha",
            "commit_author_email": "item.author.email",
            "commit_author_name": "item.author.name",
            "commit_message": "item.message",
            "commit_distinct": "item.distinct",
            "commit_url": "item.url",
        },
        explode="payload.commits",
        required="commit_sha",
    ),
    "events_pull_request": Track(
        "PullRequestEvent",
        {
            "action": "payload.action",
            "pull_request_number": "coalesce(payload.number, payload.pull_request.number)",
            "pull_request_id": "payload.pull_request.id",
            "pull_request_state": "payload.pull_request.state",
            "pull_request_title": "payload.pull_request.title",
            "pull_request_user_login": "payload.pull_request.user.login",
            "pull_request_merged": "payload.pull_request.merged",
            "pull_request_merged_at": "payload.pull_request.merged_at",
            "pull_request_merge_commit_sha": "payload.pull_request.merge_commit_sha",
            "pull_request_draft": "payload.pull_request.draft",
            "base_ref": "payload.pull_request.base.ref",
            "head_ref": "payload.pull_request.head.ref",
            "base_repo_full_name": "payload.pull_request.base.repo.full_name",
            "head_repo_full_name": "payload.pull_request.head.repo.full_name",
            "commit_count": "payload.pull_request.commits",
            "additions": "payload.pull_request.additions",
            "deletions": "payload.pull_request.deletions",
            "changed_files": "payload.pull_request.changed_files",
        },
    ),
    "events_issues": Track(
        "IssuesEvent",
        {
            "action": "payload.action",
            "issue_id": "payload.issue.id",
            "issue_number": "payload.issue.number",
            "issue_title": "payload.issue.title",
            "issue_state": "payload.issue.state",
            "issue_user_login": "payload.issue.user.login",
            "issue_comments": "payload.issue.comments",
            "issue_created_at": "payload.issue.created_at",
            "issue_closed_at": "payload.issue.closed_at",
        },
    ),
    "events_issue_comment": Track(
        "IssueCommentEvent",
        {
            "action": "payload.action",
            "issue_id": "payload.issue.id",
            "issue_number": "payload.issue.number",
            "issue_title": "payload.issue.title",
            "issue_state": "payload.issue.state",
            "comment_id": "payload.comment.id",
            "comment_user_login": "payload.comment.user.login",
            "comment_created_at": "payload.comment.created_at",
        },
    ),
    "events_pull_request_review": Track(
        "PullRequestReviewEvent",
        {
            "action": "payload.action",
            "pull_request_id": "payload.pull_request.id",
            "pull_request_number": "payload.pull_request.number",
            "pull_request_title": "payload.pull_request.title",
            "pull_request_user_login": "payload.pull_request.user.login",
            "review_id": "payload.review.id",
            "review_state": "payload.review.state",
            "review_user_login": "payload.review.user.login",
            "review_submitted_at": "payload.review.submitted_at",
        },
    ),
    "events_pull_request_review_comment": Track(
        "PullRequestReviewCommentEvent",
        {
            "action": "payload.action",
            "pull_request_id": "payload.pull_request.id",
            "pull_request_number": "payload.pull_request.number",
            "pull_request_title": "payload.pull_request.title",
            "comment_id": "payload.comment.id",
            "comment_user_login": "payload.comment.user.login",
            "comment_created_at": "payload.comment.created_at",
            "comment_path": "payload.comment.path",
            "comment_position": "payload.comment.position",
            "comment_commit_id": "payload.comment.commit_id",
        },
    ),
    "events_commit_comment": Track(
        "CommitCommentEvent",
        {
            "comment_id": "payload.comment.id",
            "commit_id": "payload.comment.commit_id",
            "comment_user_login": "payload.comment.user.login",
            "comment_created_at": "payload.comment.created_at",
        },
    ),
    "events_create": Track(
        "CreateEvent",
        {
            "ref": "payload.ref",
            "ref_type": "payload.ref_type",
            "master_branch": "payload.master_branch",
            "description": "payload.description",
            "pusher_type": "payload.pusher_type",
        },
    ),
    "events_delete": Track(
        "DeleteEvent",
        {
            "ref": "payload.ref",
            "ref_type": "payload.ref_type",
            "pusher_type": "payload.pusher_type",
        },
    ),
    "events_discussion": Track(
        "DiscussionEvent",
        {
            "action": "payload.action",
            "discussion_id": "payload.discussion.id",
            "discussion_title": "payload.discussion.title",
            "discussion_category": "payload.discussion.category.name",
        },
    ),
    "events_fork": Track(
        "ForkEvent",
        {
            "forkee_id": "payload.forkee.id",
            "forkee_full_name": "payload.forkee.full_name",
            "forkee_owner_login": "payload.forkee.owner.login",
            "forkee_created_at": "payload.forkee.created_at",
        },
    ),
    "events_gollum": Track(
        "GollumEvent",
        {"page_count": "array_size(payload.pages)", "pages": "payload.pages"},
    ),
    "events_member": Track(
        "MemberEvent",
        {
            "action": "payload.action",
            "member_id": "payload.member.id",
            "member_login": "payload.member.login",
        },
    ),
    "events_public": Track("PublicEvent", {}),
    "events_release": Track(
        "ReleaseEvent",
        {
            "action": "payload.action",
            "release_id": "payload.release.id",
            "release_tag_name": "payload.release.tag_name",
            "release_name": "payload.release.name",
            "release_draft": "payload.release.draft",
            "release_prerelease": "payload.release.prerelease",
            "release_created_at": "payload.release.created_at",
            "release_published_at": "payload.release.published_at",
            "release_author_login": "payload.release.author.login",
        },
    ),
    "events_watch": Track("WatchEvent", {"action": "payload.action"}),
}


def track(base: DataFrame, name: str) -> DataFrame:
    """One typed track of the base events.

    ``payload_parse_ok`` says whether there was a payload to read, ``payload_corrupt``
    whether its text or one of its types did not fit the schema, ``payload_variant``
    which set of top-level keys it had.
    """
    spec = TRACKS[name]
    rows = base.where(F.col("event_type") == spec.event_type)
    if spec.event_type not in PAYLOADS:  # an event type without a typed payload
        return rows.select(
            *SHARED_COLUMNS,
            F.lit(True).alias("payload_parse_ok"),
            F.lit(False).alias("payload_corrupt"),
            F.lit(NO_PAYLOAD).alias("payload_variant"),
        )

    payload = F.from_json(
        "payload_raw",
        with_corrupt(PAYLOADS[spec.event_type]),
        {"columnNameOfCorruptRecord": CORRUPT},
    )
    typed = rows.select(
        *SHARED_COLUMNS,
        payload.alias("payload"),
        payload_fingerprint("payload_raw").alias("payload_variant"),
    )
    if spec.explode:
        # The outer explode, with ``required`` dropping its empty row: an inner one lets the
        # optimiser derive filters on the payload and push them below the parse.
        typed = typed.withColumn("item", F.explode_outer(spec.explode))
    columns = [F.expr(expression).alias(column) for column, expression in spec.columns.items()]
    table = typed.select(
        *SHARED_COLUMNS,
        F.col("payload").isNotNull().alias("payload_parse_ok"),
        F.col(f"payload.{CORRUPT}").isNotNull().alias("payload_corrupt"),
        "payload_variant",
        *columns,
    )
    return table.dropna(subset=[spec.required]) if spec.required else table


def _read_once(event_type: str, exploded: str | None) -> Column:
    """Flags of a payload from one parse of it; ``items`` counts the rows it explodes to."""
    if event_type not in PAYLOADS:
        return F.struct(
            F.lit(True).alias("payload_parse_ok"),
            F.lit(False).alias("payload_corrupt"),
            F.lit(NO_PAYLOAD).alias("payload_variant"),
            F.lit(0).alias("items"),
        )
    payload = F.from_json(
        "payload_raw", with_corrupt(PAYLOADS[event_type]), {"columnNameOfCorruptRecord": CORRUPT}
    )

    def flags(p: Column) -> Column:
        items = F.lit(0)
        if exploded:
            spec = TRACKS[exploded]
            key = spec.columns[spec.required].removeprefix("item.")
            inside = p[spec.explode.removeprefix("payload.")]
            items = F.size(F.filter(inside, lambda item: item[key].isNotNull()))
        return F.struct(
            p.isNotNull().alias("payload_parse_ok"),
            p[CORRUPT].isNotNull().alias("payload_corrupt"),
            payload_fingerprint("payload_raw").alias("payload_variant"),
            F.greatest(items, F.lit(0)).alias("items"),
        )

    return F.element_at(F.transform(F.array(payload), flags), 1)


def observed_payloads(base: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """``track, dt, payload_parse_ok, payload_corrupt, payload_variant, times`` of tracks.

    What drift and profiles need of the tracks, from one scan of the base events: a payload's
    flags depend on its event type alone, and ``times`` is how many rows of the track it is
    (a push is one row of ``events_push`` and one of ``push_commits`` for each commit).
    """
    wanted = list(TRACKS) if names is None else list(names)
    whole = {TRACKS[n].event_type: n for n in wanted if not TRACKS[n].explode}
    parts = {TRACKS[n].event_type: n for n in wanted if TRACKS[n].explode}
    read, rows = None, None
    for event_type in dict.fromkeys([*whole, *parts]):
        is_type = F.col("event_type") == event_type
        flags = _read_once(event_type, parts.get(event_type))
        read = F.when(is_type, flags) if read is None else read.when(is_type, flags)
        entries = [F.struct(F.lit(whole[event_type]).alias("track"), F.lit(1).alias("times"))] if event_type in whole else []
        if event_type in parts:
            entries.append(F.struct(F.lit(parts[event_type]).alias("track"), F.col("read.items").alias("times")))
        own = F.array(*entries)
        rows = F.when(is_type, own) if rows is None else rows.when(is_type, own)
    # A one-element explode keeps filters on the flags above the parse.
    seen = base.where(F.col("event_type").isin([*whole, *parts])).select(
        "dt", "event_type", F.explode(F.array(read)).alias("read")
    )
    return (
        seen.select("dt", "read", F.explode(rows).alias("row"))
        .where("row.times > 0")
        .select(
            "row.track",
            "dt",
            "read.payload_parse_ok",
            "read.payload_corrupt",
            "read.payload_variant",
            F.col("row.times").cast("long").alias("times"),
        )
    )


def all_tracks(base: DataFrame) -> dict[str, DataFrame]:
    return {name: track(base, name) for name in TRACKS}
