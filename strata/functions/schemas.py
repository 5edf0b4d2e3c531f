"""Fixed superset schemas of the event envelope and of every typed payload.

A field missing from a record reads as NULL; a field missing from the schema is
ignored here but stays in ``payload_raw``. Everything is nullable.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

LONG, INT, STRING = T.LongType(), T.IntegerType(), T.StringType()
BOOL, DATE, TIMESTAMP = T.BooleanType(), T.DateType(), T.TimestampType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema plus the column in which ``from_json`` reports text it could not read in full."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, STRING, True)])


# Field names and types of the archive's JSON documents.
USER = record(id=LONG, login=STRING)
ACTOR = record(
    id=LONG, login=STRING, display_login=STRING, gravatar_id=STRING, url=STRING, avatar_url=STRING
)
REPO = record(id=LONG, name=STRING, url=STRING)
ORG = record(id=LONG, login=STRING, gravatar_id=STRING, url=STRING, avatar_url=STRING)
EVENT = record(
    id=STRING, type=STRING, actor=ACTOR, repo=REPO, public=BOOL, created_at=STRING, org=ORG
)

COMMIT = record(
    sha=STRING,
    author=record(email=STRING, name=STRING),
    message=STRING,
    distinct=BOOL,
    url=STRING,
)
BRANCH = record(ref=STRING, repo=record(full_name=STRING))
PULL_REQUEST = record(
    id=LONG,
    number=LONG,
    state=STRING,
    title=STRING,
    user=USER,
    merged=BOOL,
    merged_at=STRING,
    merge_commit_sha=STRING,
    draft=BOOL,
    base=BRANCH,
    head=BRANCH,
    commits=INT,
    additions=INT,
    deletions=INT,
    changed_files=INT,
)
ISSUE = record(
    id=LONG,
    number=LONG,
    title=STRING,
    state=STRING,
    user=USER,
    comments=INT,
    created_at=STRING,
    closed_at=STRING,
)
ISSUE_COMMENT = record(id=LONG, user=USER, created_at=STRING)
REVIEW = record(id=LONG, state=STRING, user=USER, submitted_at=STRING)
REVIEW_COMMENT = record(
    id=LONG, user=USER, created_at=STRING, path=STRING, position=INT, commit_id=STRING
)
COMMIT_COMMENT = record(id=LONG, commit_id=STRING, user=USER, created_at=STRING)
DISCUSSION = record(id=LONG, title=STRING, category=record(name=STRING))
FORKEE = record(id=LONG, full_name=STRING, owner=USER, created_at=STRING)
WIKI_PAGE = record(page_name=STRING, title=STRING, action=STRING, sha=STRING)
RELEASE = record(
    id=LONG,
    tag_name=STRING,
    name=STRING,
    draft=BOOL,
    prerelease=BOOL,
    created_at=STRING,
    published_at=STRING,
    author=USER,
)

# Payload shape of each typed event type.
PAYLOADS: dict[str, T.StructType] = {
    "PushEvent": record(
        repository_id=LONG,
        push_id=LONG,
        size=INT,
        distinct_size=INT,
        ref=STRING,
        head=STRING,
        before=STRING,
        commits=T.ArrayType(COMMIT),
    ),
    "PullRequestEvent": record(action=STRING, number=LONG, pull_request=PULL_REQUEST),
    "IssuesEvent": record(action=STRING, issue=ISSUE),
    "IssueCommentEvent": record(action=STRING, issue=ISSUE, comment=ISSUE_COMMENT),
    "PullRequestReviewEvent": record(action=STRING, review=REVIEW, pull_request=PULL_REQUEST),
    "PullRequestReviewCommentEvent": record(
        action=STRING, comment=REVIEW_COMMENT, pull_request=PULL_REQUEST
    ),
    "CommitCommentEvent": record(comment=COMMIT_COMMENT),
    "CreateEvent": record(
        ref=STRING, ref_type=STRING, master_branch=STRING, description=STRING, pusher_type=STRING
    ),
    "DeleteEvent": record(ref=STRING, ref_type=STRING, pusher_type=STRING),
    "DiscussionEvent": record(action=STRING, discussion=DISCUSSION),
    "ForkEvent": record(forkee=FORKEE),
    "GollumEvent": record(pages=T.ArrayType(WIKI_PAGE)),
    "MemberEvent": record(action=STRING, member=USER),
    "ReleaseEvent": record(action=STRING, release=RELEASE),
    "WatchEvent": record(action=STRING),
}

# Columns of the silver base table.
EVENTS_BASE = record(
    dt=DATE,
    created_at=STRING,
    created_at_ts=TIMESTAMP,
    event_id=STRING,
    event_type=STRING,
    actor_id=LONG,
    actor_login=STRING,
    actor_display_login=STRING,
    actor_gravatar_id=STRING,
    actor_url=STRING,
    actor_avatar_url=STRING,
    repo_id=LONG,
    repo_name=STRING,
    repo_url=STRING,
    org_id=LONG,
    org_login=STRING,
    org_gravatar_id=STRING,
    org_url=STRING,
    org_avatar_url=STRING,
    public=BOOL,
    payload_raw=STRING,
    source_file=STRING,
)
