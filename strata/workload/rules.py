"""How archive lines and pull requests are derived from the benchmark tables.

Plain SQL expressions that Spark and DuckDB both run, so that both sides start from the
same rows. Nothing here uses the library: its results are what the rules are to check.
"""

from __future__ import annotations

DRIFT_DAY = "2024-01-16"  # payload shapes change on this day

# --- facts about one event: e = event id, u = user, k = the number in props ---------------

# event type of the table -> event types of the archive, told apart by e modulo their number
KINDS = {
    "click": ["PushEvent"],
    "view": ["WatchEvent", "ForkEvent", "PublicEvent", "GollumEvent"],
    "signup": ["CreateEvent", "DeleteEvent", "MemberEvent", "ReleaseEvent"],
    "purchase": [
        "PullRequestEvent",
        "PullRequestReviewEvent",
        "PullRequestReviewCommentEvent",
        "DiscussionEvent",
    ],
    "error": ["IssuesEvent", "IssueCommentEvent", "CommitCommentEvent"],
}

KIND = (
    "CASE "
    + " ".join(
        f"WHEN event_type = '{table_type}' AND event_id % {len(kinds)} = {i} THEN '{kind}'"
        for table_type, kinds in KINDS.items()
        for i, kind in enumerate(kinds)
    )
    + " END"
)

FACTS = {
    "e": "event_id",
    "u": "user_id",
    "k": "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)",
    "dt": "CAST(ts AS DATE)",
    "kind": KIND,
    "table_type": "event_type",
    "login": "CASE WHEN event_id % 97 <> 0 THEN 'user_' || user_id END",
    # Faults: at most one per line, the first that applies.
    "fault": (
        "CASE WHEN event_id % 107 = 0 THEN 'blank' WHEN event_id % 101 = 0 THEN 'malformed' "
        "WHEN event_id % 103 = 0 THEN 'bad time' WHEN event_id % 109 = 0 THEN 'no payload' "
        "WHEN event_id % 113 = 0 THEN 'wrong type' ELSE 'none' END"
    ),
}

# Over the facts.
REPO_NAME = "CASE WHEN e % 89 <> 0 THEN 'repo_' || k END"
IS_READABLE = "fault NOT IN ('blank', 'malformed')"
IS_VALID = "fault NOT IN ('blank', 'malformed', 'bad time')"
IS_OLD = f"dt < DATE '{DRIFT_DAY}'"
IS_LATE = "e % 127 = 0"  # the line lies in the file of the next day
PUSH_REF = (
    "CASE e % 6 WHEN 0 THEN 'refs/heads/main' WHEN 1 THEN 'refs/heads/master' "
    "WHEN 2 THEN 'refs/heads/dev-1' WHEN 3 THEN 'refs/tags/v1' WHEN 4 THEN 'main' END"
)

# --- JSON text as SQL concatenation ------------------------------------------------------


def text(expression: str) -> str:
    return f"coalesce('\"' || ({expression}) || '\"', 'null')"


def number(expression: str) -> str:
    return f"coalesce('' || ({expression}), 'null')"


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'true' ELSE 'false' END"


def obj(**fields: str) -> str:
    """A JSON object; a value is a SQL expression that gives JSON text."""
    members = " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in fields.items())
    return f"('{{' || {members} || '}}')" if fields else "'{}'"


def first_of(count: str, items: list[str]) -> str:
    """A JSON array of the first ``count`` (0, 1, 2) of two items."""
    return (
        f"(CASE {count} WHEN 0 THEN '[]' WHEN 1 THEN '[' || {items[0]} || ']' "
        f"ELSE '[' || {items[0]} || ',' || {items[1]} || ']' END)"
    )


USER = obj(id=number("u"), login=text("'user_' || u"))


def commit_fields(i: int) -> dict[str, str]:
    return {
        "commit_sha": f"CASE WHEN NOT (e % 5 = 0 AND {i} = 1) THEN 'c' || e || '-{i}' END",
        "commit_author_email": "'u' || u || '@example.org'",
        "commit_author_name": "'User ' || u",
        "commit_message": f"'change {i} of ' || e",
        "commit_distinct": "TRUE" if i == 1 else "FALSE",
        "commit_url": f"'https://example.org/c/' || e || '/{i}'",
    }


def _commit(i: int) -> str:
    f = commit_fields(i)
    return obj(
        sha=text(f["commit_sha"]),
        author=obj(email=text(f["commit_author_email"]), name=text(f["commit_author_name"])),
        message=text(f["commit_message"]),
        distinct=f"'{f['commit_distinct'].lower()}'",
        url=text(f["commit_url"]),
    )


def _page(i: int) -> str:
    return obj(
        page_name=text(f"'Page {i}'"),
        title=text(f"'Title ' || k || '-{i}'"),
        action=text("'edited'"),
        sha=text(f"'p' || e || '-{i}'"),
    )


# Expected values of the typed columns, over the facts (created_at is the event's time text).
RELEASE_NAME = "CASE WHEN e % 5 <> 0 THEN 'Release ' || k END"
CREATE_TYPE = "CASE e % 3 WHEN 0 THEN 'branch' WHEN 1 THEN 'tag' ELSE 'repository' END"
CREATE_REF = "CASE WHEN e % 3 <> 2 THEN 'ref-' || k END"
CREATE_ABOUT = "CASE WHEN e % 5 <> 0 THEN 'about ' || k END"
PR_ACTION = "CASE e % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'reopened' END"
PR_MERGED = "(e % 3 = 1 AND k % 2 = 0)"
PR_STATE = "CASE WHEN e % 3 = 1 THEN 'closed' ELSE 'open' END"
REVIEW_STATE = (
    "CASE k % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'commented' ELSE 'changes_requested' END"
)
ISSUE_STATE = "CASE WHEN k % 2 = 0 THEN 'open' ELSE 'closed' END"
ISSUE_CLOSED = "CASE WHEN k % 2 = 1 THEN created_at END"
REPOSITORY_ID = "CASE WHEN fault <> 'wrong type' THEN k END"
PAGES = first_of("e % 3", [_page(1), _page(2)])

_PUSH_OLD = dict(
    repository_id=f"CASE WHEN fault = 'wrong type' THEN {text('k')} ELSE {number('k')} END",
    push_id=number("e"),
    size=number("e % 4"),
    distinct_size=number("e % 3"),
    ref=text(PUSH_REF),
    head=text("'h' || e"),
    before=text("'b' || e"),
    commits=first_of("e % 3", [_commit(1), _commit(2)]),
)
_PUSH_NEW = {
    k: v for k, v in _PUSH_OLD.items() if k not in ("size", "distinct_size", "commits")
}
_CREATE = dict(
    ref=text(CREATE_REF),
    ref_type=text(CREATE_TYPE),
    master_branch=text("'main'"),
    description=text(CREATE_ABOUT),
    pusher_type=text("'user'"),
)
_PULL_REQUEST = obj(
    id=number("e"),
    number=number("k + 1"),
    state=text(PR_STATE),
    title=text("'PR ' || e"),
    user=USER,
    merged=flag(PR_MERGED),
    merged_at=text(f"CASE WHEN {PR_MERGED} THEN created_at END"),
    merge_commit_sha=text(f"CASE WHEN {PR_MERGED} THEN 'm' || e END"),
    draft=flag("k % 5 = 0"),
    base=obj(ref=text("'main'"), repo=obj(full_name=text("'org/repo_' || k"))),
    head=obj(
        ref=text("'topic-' || k"), repo=obj(full_name=text("'user_' || u || '/repo_' || k"))
    ),
    commits=number("k % 7"),
    additions=number("k * 3"),
    deletions=number("k % 11"),
    changed_files=number("k % 13"),
)
# The pull request under review is the one that the event before may have opened.
_REVIEWED = obj(
    id=number("e - e % 4"), number=number("k + 1"), title=text("'PR ' || (e - e % 4)"), user=USER
)

PAYLOADS = {
    "PushEvent": f"CASE WHEN {IS_OLD} THEN {obj(**_PUSH_OLD)} ELSE {obj(**_PUSH_NEW)} END",
    "WatchEvent": obj(action=text("'started'")),
    "ForkEvent": obj(
        forkee=obj(
            id=number("e * 10"),
            full_name=text("'user_' || u || '/fork_' || k"),
            owner=USER,
            created_at=text("created_at"),
        )
    ),
    "PublicEvent": obj(),
    "GollumEvent": f"CASE WHEN e % 7 = 0 THEN '{{}}' ELSE {obj(pages=PAGES)} END",
    "CreateEvent": (
        f"CASE WHEN {IS_OLD} THEN {obj(**_CREATE)} "
        f"ELSE {obj(full_ref=text(CREATE_REF), **_CREATE)} END"
    ),
    "DeleteEvent": obj(
        ref=text("'ref-' || k"), ref_type=text("'branch'"), pusher_type=text("'user'")
    ),
    "MemberEvent": obj(
        action=text("'added'"), member=obj(id=number("u + 1"), login=text("'user_' || (u + 1)"))
    ),
    "ReleaseEvent": obj(
        action=text("'published'"),
        release=obj(
            id=number("e * 7"),
            tag_name=text("'v' || k"),
            name=text(RELEASE_NAME),
            draft=flag("e % 8 = 3"),
            prerelease=flag("k % 2 = 0"),
            created_at=text("created_at"),
            published_at=text("created_at"),
            author=USER,
        ),
    ),
    "PullRequestEvent": (
        f"CASE WHEN e % 8 = 0 THEN {obj(action=text(PR_ACTION), pull_request=_PULL_REQUEST)} ELSE "
        f"{obj(action=text(PR_ACTION), number=number('k + 1'), pull_request=_PULL_REQUEST)} END"
    ),
    "PullRequestReviewEvent": obj(
        action=text("'created'"),
        review=obj(
            id=number("e"), state=text(REVIEW_STATE), user=USER, submitted_at=text("created_at")
        ),
        pull_request=_REVIEWED,
    ),
    "PullRequestReviewCommentEvent": obj(
        action=text("'created'"),
        comment=obj(
            id=number("e"),
            user=USER,
            created_at=text("created_at"),
            path=text("'src/file_' || k"),
            position=number("k % 17"),
            commit_id=text("'c' || e"),
        ),
        pull_request=_REVIEWED,
    ),
    "DiscussionEvent": obj(
        action=text("'created'"),
        discussion=obj(
            id=number("e"), title=text("'Topic ' || k"), category=obj(name=text("'Ideas'"))
        ),
    ),
    "IssuesEvent": obj(
        action=text("'opened'"),
        issue=obj(
            id=number("e"),
            number=number("k"),
            title=text("'Issue ' || e"),
            state=text(ISSUE_STATE),
            user=USER,
            comments=number("k % 9"),
            created_at=text("created_at"),
            closed_at=text(ISSUE_CLOSED),
        ),
    ),
    "IssueCommentEvent": obj(
        action=text("'created'"),
        issue=obj(
            id=number("e - 1"),
            number=number("k"),
            title=text("'Issue ' || (e - 1)"),
            state=text(ISSUE_STATE),
        ),
        comment=obj(id=number("e"), user=USER, created_at=text("created_at")),
    ),
    "CommitCommentEvent": obj(
        comment=obj(
            id=number("e"),
            commit_id=text("'c' || e"),
            user=USER,
            created_at=text("created_at"),
        )
    ),
}
PAYLOAD_TEXT = (
    "CASE WHEN fault = 'no payload' THEN NULL "
    + " ".join(f"WHEN kind = '{kind}' THEN {payload}" for kind, payload in PAYLOADS.items())
    + " END"
)

# LINE is over facts with created_at and payload_text, RAW_JSON over those and line.
_ORG = obj(
    id=number("k + 1000"),
    login=text("'org_' || k"),
    gravatar_id=text("''"),
    url=text("'https://example.org/orgs/' || k"),
    avatar_url=text("'https://example.org/orgs/' || k || '.png'"),
)
LINE = obj(
    id=text("e"),
    type=text("kind"),
    actor=obj(
        id=f"CASE WHEN fault = 'wrong type' THEN {text('u')} ELSE {number('u')} END",
        login=text("login"),
        display_login=text("login"),
        gravatar_id=text("''"),
        url=text("'https://example.org/users/' || u"),
        avatar_url=text("'https://example.org/users/' || u || '.png'"),
    ),
    repo=obj(
        id=number("k"), name=text(REPO_NAME), url=text("'https://example.org/repos/' || k")
    ),
    payload="coalesce(payload_text, 'null')",
    public="'true'",
    created_at=text("created_at"),
)
_ORG_MEMBER = f"CASE WHEN e % 3 = 0 THEN ',\"org\":' || {_ORG} ELSE '' END"
RAW_JSON = (
    "CASE WHEN fault = 'blank' THEN '' ELSE "
    "(CASE WHEN fault = 'malformed' THEN '#' ELSE '' END) || "
    f"substr(line, 1, length(line) - 1) || ({_ORG_MEMBER}) || '}}' END"
)

# --- pull requests from orders, reviews from line items -----------------------------------

# A third of all pull requests lies in one repository, a few in one without a name.
PR_REPO = (
    "CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'repo_0' "
    "ELSE 'repo_' || (o_custkey % 50) END"
)
