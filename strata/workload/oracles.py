"""The expected rows of each query as DuckDB SQL, computed without any JSON parsing."""

from __future__ import annotations

from strata.operators.drift import CHECKED_TRACKS
from strata.workload import rules
from strata.workload.rules import IS_LATE, IS_OLD, IS_READABLE, IS_VALID


def _half_up(expression: str, digits: int = 6) -> str:
    """Rounding with halves sent up, in plain arithmetic that every engine does alike."""
    return f"floor(({expression}) * 1e{digits} + 0.5) / 1e{digits}"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def _with(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


# --- common table expressions ------------------------------------------------------------

_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_FACTS = f"""facts0 AS (
  SELECT {_select(rules.FACTS)}, ts,
    CASE WHEN event_id % 127 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS file_ts
  FROM events
), facts AS (
  SELECT *,
    CASE WHEN fault = 'bad time' THEN replace({_TIME}, 'Z', '.5Z') ELSE {_TIME} END AS created_at,
    'archive/' || strftime(file_ts, '%Y/%m/%d/%Y-%m-%d-') || hour(file_ts) || '.json.gz'
      AS source_file
  FROM facts0
)"""
_RAW = f"""raw AS (
  SELECT *, {rules.RAW_JSON} AS raw_json FROM (
    SELECT *, {rules.LINE} AS line FROM (
      SELECT *, {rules.PAYLOAD_TEXT} AS payload_text FROM facts)))"""
_EVENTS = f"""v_events AS (
  SELECT dt, {rules.REPO_NAME} AS repo_name, login AS actor_login, table_type AS event_type,
    CAST(e AS VARCHAR) AS event_id
  FROM facts)"""
_PUSHES = f"""v_push AS (
  SELECT dt, {rules.PUSH_REF} AS ref FROM facts WHERE kind = 'PushEvent')"""

_SHARED = {
    "dt": "dt",
    "created_at_ts": "CAST(epoch(date_trunc('second', ts)) AS BIGINT)",
    "event_id": "CAST(e AS VARCHAR)",
    "event_type": "kind",
    "actor_id": "CASE WHEN fault <> 'wrong type' THEN u END",
    "actor_login": "login",
    "actor_display_login": "login",
    "repo_id": "k",
    "repo_name": rules.REPO_NAME,
    "repo_url": "'https://example.org/repos/' || k",
    "org_id": "CASE WHEN e % 3 = 0 THEN k + 1000 END",
    "org_login": "CASE WHEN e % 3 = 0 THEN 'org_' || k END",
    "public": "TRUE",
    "source_file": "source_file",
}
_BASE_COLUMNS = {
    **_SHARED,
    "created_at": "created_at",
    "actor_gravatar_id": "''",
    "actor_url": "'https://example.org/users/' || u",
    "actor_avatar_url": "'https://example.org/users/' || u || '.png'",
    "org_gravatar_id": "CASE WHEN e % 3 = 0 THEN '' END",
    "org_url": "CASE WHEN e % 3 = 0 THEN 'https://example.org/orgs/' || k END",
    "org_avatar_url": "CASE WHEN e % 3 = 0 THEN 'https://example.org/orgs/' || k || '.png' END",
    "payload_raw": "payload_text",
}

# --- tracks ------------------------------------------------------------------------------

_TRACK_KIND = {
    "events_push": "PushEvent",
    "events_pull_request": "PullRequestEvent",
    "events_issues": "IssuesEvent",
    "events_issue_comment": "IssueCommentEvent",
    "events_pull_request_review": "PullRequestReviewEvent",
    "events_pull_request_review_comment": "PullRequestReviewCommentEvent",
    "events_commit_comment": "CommitCommentEvent",
    "events_create": "CreateEvent",
    "events_delete": "DeleteEvent",
    "events_discussion": "DiscussionEvent",
    "events_fork": "ForkEvent",
    "events_gollum": "GollumEvent",
    "events_member": "MemberEvent",
    "events_public": "PublicEvent",
    "events_release": "ReleaseEvent",
    "events_watch": "WatchEvent",
}
_TRACK = (
    "CASE kind "
    + " ".join(f"WHEN '{kind}' THEN '{name}'" for name, kind in _TRACK_KIND.items())
    + " END"
)
# Top-level keys of each payload, sorted.
_KEYS = f"""CASE
  WHEN kind = 'PushEvent' AND {IS_OLD}
    THEN 'before,commits,distinct_size,head,push_id,ref,repository_id,size'
  WHEN kind = 'PushEvent' THEN 'before,head,push_id,ref,repository_id'
  WHEN kind = 'WatchEvent' THEN 'action'
  WHEN kind = 'ForkEvent' THEN 'forkee'
  WHEN kind = 'GollumEvent' THEN CASE WHEN e % 7 = 0 THEN '' ELSE 'pages' END
  WHEN kind = 'CreateEvent' AND {IS_OLD}
    THEN 'description,master_branch,pusher_type,ref,ref_type'
  WHEN kind = 'CreateEvent' THEN 'description,full_ref,master_branch,pusher_type,ref,ref_type'
  WHEN kind = 'DeleteEvent' THEN 'pusher_type,ref,ref_type'
  WHEN kind = 'MemberEvent' THEN 'action,member'
  WHEN kind = 'ReleaseEvent' THEN 'action,release'
  WHEN kind = 'PullRequestEvent' AND e % 8 = 0 THEN 'action,pull_request'
  WHEN kind = 'PullRequestEvent' THEN 'action,number,pull_request'
  WHEN kind = 'PullRequestReviewEvent' THEN 'action,pull_request,review'
  WHEN kind = 'PullRequestReviewCommentEvent' THEN 'action,comment,pull_request'
  WHEN kind = 'DiscussionEvent' THEN 'action,discussion'
  WHEN kind = 'IssuesEvent' THEN 'action,issue'
  WHEN kind = 'IssueCommentEvent' THEN 'action,comment,issue'
  WHEN kind = 'CommitCommentEvent' THEN 'comment'
END"""
_VERDICT = {
    "payload_parse_ok": "(kind = 'PublicEvent' OR fault <> 'no payload')",
    "payload_corrupt": "(kind = 'PushEvent' AND fault = 'wrong type')",
    "payload_variant": (
        "CASE WHEN kind = 'PublicEvent' THEN 'no_payload' "
        f"WHEN fault = 'no payload' THEN 'parse_fail' ELSE sha256({_KEYS}) END"
    ),
}
_USER = "'user_' || u"
_PUSH = {
    "repository_id": rules.REPOSITORY_ID,
    "push_id": "e",
    "ref": rules.PUSH_REF,
    "head": "'h' || e",
    "before": "'b' || e",
}
_TYPED: dict[str, dict[str, str]] = {
    "events_pull_request": {
        "action": rules.PR_ACTION,
        "pull_request_number": "k + 1",
        "pull_request_id": "e",
        "pull_request_state": rules.PR_STATE,
        "pull_request_title": "'PR ' || e",
        "pull_request_user_login": _USER,
        "pull_request_merged": rules.PR_MERGED,
        "pull_request_merged_at": f"CASE WHEN {rules.PR_MERGED} THEN created_at END",
        "pull_request_merge_commit_sha": f"CASE WHEN {rules.PR_MERGED} THEN 'm' || e END",
        "pull_request_draft": "(k % 5 = 0)",
        "base_ref": "'main'",
        "head_ref": "'topic-' || k",
        "base_repo_full_name": "'org/repo_' || k",
        "head_repo_full_name": f"{_USER} || '/repo_' || k",
        "commit_count": "CAST(k % 7 AS INTEGER)",
        "additions": "CAST(k * 3 AS INTEGER)",
        "deletions": "CAST(k % 11 AS INTEGER)",
        "changed_files": "CAST(k % 13 AS INTEGER)",
    },
    "events_issues": {
        "action": "'opened'",
        "issue_id": "e",
        "issue_number": "k",
        "issue_title": "'Issue ' || e",
        "issue_state": rules.ISSUE_STATE,
        "issue_user_login": _USER,
        "issue_comments": "CAST(k % 9 AS INTEGER)",
        "issue_created_at": "created_at",
        "issue_closed_at": rules.ISSUE_CLOSED,
    },
    "events_issue_comment": {
        "action": "'created'",
        "issue_id": "e - 1",
        "issue_number": "k",
        "issue_title": "'Issue ' || (e - 1)",
        "issue_state": rules.ISSUE_STATE,
        "comment_id": "e",
        "comment_user_login": _USER,
        "comment_created_at": "created_at",
    },
    "events_pull_request_review": {
        "action": "'created'",
        "pull_request_id": "e - e % 4",
        "pull_request_number": "k + 1",
        "pull_request_title": "'PR ' || (e - e % 4)",
        "pull_request_user_login": _USER,
        "review_id": "e",
        "review_state": rules.REVIEW_STATE,
        "review_user_login": _USER,
        "review_submitted_at": "created_at",
    },
    "events_pull_request_review_comment": {
        "action": "'created'",
        "pull_request_id": "e - e % 4",
        "pull_request_number": "k + 1",
        "pull_request_title": "'PR ' || (e - e % 4)",
        "comment_id": "e",
        "comment_user_login": _USER,
        "comment_created_at": "created_at",
        "comment_path": "'src/file_' || k",
        "comment_position": "CAST(k % 17 AS INTEGER)",
        "comment_commit_id": "'c' || e",
    },
    "events_commit_comment": {
        "comment_id": "e",
        "commit_id": "'c' || e",
        "comment_user_login": _USER,
        "comment_created_at": "created_at",
    },
    "events_create": {
        "ref": rules.CREATE_REF,
        "ref_type": rules.CREATE_TYPE,
        "master_branch": "'main'",
        "description": rules.CREATE_ABOUT,
        "pusher_type": "'user'",
    },
    "events_delete": {
        "ref": "'ref-' || k",
        "ref_type": "'branch'",
        "pusher_type": "'user'",
    },
    "events_discussion": {
        "action": "'created'",
        "discussion_id": "e",
        "discussion_title": "'Topic ' || k",
        "discussion_category": "'Ideas'",
    },
    "events_fork": {
        "forkee_id": "e * 10",
        "forkee_full_name": f"{_USER} || '/fork_' || k",
        "forkee_owner_login": _USER,
        "forkee_created_at": "created_at",
    },
    "events_gollum": {
        "page_count": "CASE WHEN e % 7 <> 0 THEN CAST(e % 3 AS INTEGER) END",
        "pages": f"CASE WHEN e % 7 <> 0 THEN {rules.PAGES} END",
    },
    "events_member": {
        "action": "'added'",
        "member_id": "u + 1",
        "member_login": "'user_' || (u + 1)",
    },
    "events_public": {},
    "events_release": {
        "action": "'published'",
        "release_id": "e * 7",
        "release_tag_name": "'v' || k",
        "release_name": rules.RELEASE_NAME,
        "release_draft": "(e % 8 = 3)",
        "release_prerelease": "(k % 2 = 0)",
        "release_created_at": "created_at",
        "release_published_at": "created_at",
        "release_author_login": _USER,
    },
    "events_watch": {"action": "'started'"},
}


def _if_payload(columns: dict[str, str]) -> dict[str, str]:
    return {
        name: f"CASE WHEN fault <> 'no payload' THEN {expression} END"
        for name, expression in columns.items()
    }


def _old_push(expression: str) -> str:
    return f"CASE WHEN {IS_OLD} AND fault <> 'no payload' THEN CAST({expression} AS INTEGER) END"


_TYPED["events_push"] = _PUSH
_COMMITS = f"""commits AS (
  SELECT * FROM facts, (VALUES (1), (2)) AS c(i)
  WHERE {IS_VALID} AND kind = 'PushEvent' AND {IS_OLD} AND fault <> 'no payload'
    AND i <= e % 3 AND NOT (e % 5 = 0 AND i = 1))"""


def _by_commit(name: str) -> str:
    first, second = (rules.commit_fields(i)[name] for i in (1, 2))
    return f"CASE WHEN i = 1 THEN {first} ELSE {second} END"


def _track_sql(name: str) -> str:
    if name == "push_commits":
        columns = {
            **_SHARED,
            **_VERDICT,
            "repository_id": rules.REPOSITORY_ID,
            "push_id": "e",
            "push_size": "CAST(e % 4 AS INTEGER)",
            "push_distinct_size": "CAST(e % 3 AS INTEGER)",
            **{column: _by_commit(column) for column in rules.commit_fields(1)},
        }
        return _with(_FACTS, _COMMITS, select=f"SELECT {_select(columns)} FROM commits")
    columns = {**_SHARED, **_VERDICT, **_if_payload(_TYPED[name])}
    if name == "events_push":
        columns |= {
            "push_size": f"coalesce({_old_push('e % 4')}, 0)",
            "push_distinct_size": f"coalesce({_old_push('e % 3')}, 0)",
            "commit_count": f"coalesce({_old_push('e % 3')}, 0)",
        }
    rows = f"FROM facts WHERE {IS_VALID} AND kind = '{_TRACK_KIND[name]}'"
    return _with(_FACTS, select=f"SELECT {_select(columns)} {rows}")


# --- marts over any base with dt, repo_name, actor_login, event_type ---------------------

_JANUARY = "DATE '2024-01-01' AS start_dt, DATE '2024-01-31' AS end_dt"


def _top(base: str, key: str, metric: str, aggregate: str, n: int, where: str = "TRUE") -> str:
    return (
        f"SELECT {key}, {aggregate} AS {metric} FROM {base} WHERE {where} "
        f"GROUP BY {key} ORDER BY {metric} DESC, {key} ASC NULLS FIRST LIMIT {n}"
    )


def _stamped(sql: str) -> str:
    return f"SELECT *, {_JANUARY} FROM ({sql})"


_KNOWN = "actor_login IS NOT NULL"
_ACTORS_BY_EVENTS = ("actor_login", "actor_event_count", "count(*)", 10, _KNOWN)
_ACTORS_BY_REPOS = (
    "actor_login", "actor_repo_count", "count(DISTINCT repo_name)", 10, _KNOWN
)


def _breakdown(base: str, top: str, key: str, metric: str) -> str:
    return _stamped(
        f"SELECT b.{key}, b.event_type, count(*) AS event_type_count, max(t.{metric}) AS {metric} "
        f"FROM {base} b JOIN ({top}) t ON b.{key} = t.{key} GROUP BY 1, 2"
    )


def _daily_top(base: str) -> str:
    return _stamped(
        "SELECT dt, repo_name, event_count, CAST(daily_rank AS INTEGER) AS daily_rank "
        "FROM (SELECT *, row_number() OVER ("
        "PARTITION BY dt ORDER BY event_count DESC, repo_name ASC NULLS FIRST) AS daily_rank "
        f"FROM (SELECT dt, repo_name, count(*) AS event_count FROM {base} GROUP BY 1, 2)) "
        "WHERE daily_rank <= 10"
    )


_BRANCHES = (
    "SELECT dt, CASE WHEN ref IS NULL THEN 'unknown' WHEN ref IN ('main', 'refs/heads/main') "
    "THEN 'main' WHEN ref IN ('master', 'refs/heads/master') THEN 'master' ELSE 'other' END "
    "AS branch_group, count(*) AS push_count FROM {base} GROUP BY 1, 2"
)


def _branch_ratio(base: str) -> str:
    counts = _BRANCHES.format(base=base)
    return _stamped(
        "SELECT c.*, CAST(t.total_push_count AS BIGINT) AS total_push_count, "
        f"{_half_up('c.push_count / t.total_push_count')} AS branch_ratio "
        f"FROM ({counts}) c JOIN (SELECT dt, sum(push_count) AS total_push_count "
        f"FROM ({counts}) GROUP BY dt) t ON c.dt = t.dt"
    )


# --- pull requests -----------------------------------------------------------------------

_ORDERS_PR = f"""v_pr AS (
  SELECT {rules.PR_REPO} AS repo_name, o_orderkey AS pull_request_id,
    o_orderdate AS created_at_ts,
    CASE WHEN o_orderstatus = 'P' THEN 'reopened' ELSE 'opened' END AS action,
    FALSE AS pull_request_merged, CAST(NULL AS TIMESTAMP) AS merged_at,
    CAST(o_orderkey % 7 AS INTEGER) AS commit_count,
    CAST(o_orderkey % 501 AS INTEGER) AS additions,
    CAST(o_orderkey % 97 AS INTEGER) AS deletions,
    CAST(o_orderkey % 13 AS INTEGER) AS changed_files
  FROM orders
  UNION ALL
  SELECT {rules.PR_REPO}, o_orderkey, o_orderdate + INTERVAL 3 DAY, 'closed', TRUE,
    o_orderdate + INTERVAL 3 DAY, CAST(o_orderkey % 5 AS INTEGER),
    CAST(o_orderkey % 777 AS INTEGER), CAST(o_orderkey % 31 AS INTEGER),
    CAST(o_orderkey % 17 AS INTEGER)
  FROM orders WHERE o_orderstatus = 'F'
), v_line AS (
  SELECT {rules.PR_REPO} AS repo_name, l_orderkey AS pull_request_id,
    l_shipdate + to_hours(l_partkey % 24) AS shown_at, lineitem.*
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), v_review AS (
  SELECT repo_name, pull_request_id, shown_at AS submitted_at,
    CASE WHEN l_partkey % 53 <> 0 THEN l_linenumber END AS review_id,
    l_returnflag = 'A' AS is_approval
  FROM v_line
), v_rcomment AS (
  SELECT repo_name, pull_request_id, shown_at AS commented_at, l_partkey AS comment_id
  FROM v_line WHERE l_linestatus = 'O'
)"""
_SILVER_PR = f"""v_pr AS (
  SELECT {rules.REPO_NAME} AS repo_name, {_if_payload({'x': 'e'})['x']} AS pull_request_id,
    date_trunc('second', ts) AS created_at_ts, {rules.PR_ACTION} AS action,
    {rules.PR_MERGED} AS pull_request_merged,
    CASE WHEN {rules.PR_MERGED} THEN date_trunc('second', ts) END AS merged_at,
    k % 7 AS commit_count, k * 3 AS additions, k % 11 AS deletions, k % 13 AS changed_files
  FROM silver WHERE kind = 'PullRequestEvent'
), v_review AS (
  SELECT {rules.REPO_NAME} AS repo_name, e - e % 4 AS pull_request_id,
    date_trunc('second', ts) AS submitted_at, e AS review_id,
    {rules.REVIEW_STATE} = 'approved' AS is_approval
  FROM silver WHERE kind = 'PullRequestReviewEvent' AND fault <> 'no payload'
), v_rcomment AS (
  SELECT {rules.REPO_NAME} AS repo_name, e - e % 4 AS pull_request_id,
    date_trunc('second', ts) AS commented_at, e AS comment_id
  FROM silver WHERE kind = 'PullRequestReviewCommentEvent' AND fault <> 'no payload'
)"""
_PR_STATS = """pr_base AS (
  SELECT repo_name, pull_request_id,
    min(CASE WHEN action = 'opened' THEN created_at_ts END) AS opened_at,
    max(merged_at) AS merged_at, max(pull_request_merged) AS pull_request_merged,
    max(commit_count) AS commit_count, max(additions) AS additions,
    max(deletions) AS deletions, max(changed_files) AS changed_files,
    CAST(min(CASE WHEN action = 'opened' THEN created_at_ts END) AS DATE) AS dt
  FROM v_pr WHERE pull_request_id IS NOT NULL
  GROUP BY repo_name, pull_request_id
  HAVING min(CASE WHEN action = 'opened' THEN created_at_ts END) IS NOT NULL
), review_stats AS (
  SELECT repo_name, pull_request_id, min(submitted_at) AS first_review_at,
    count(DISTINCT review_id) AS review_count,
    count(*) FILTER (WHERE is_approval) AS approval_count
  FROM v_review WHERE pull_request_id IS NOT NULL AND review_id IS NOT NULL GROUP BY 1, 2
), comment_stats AS (
  SELECT repo_name, pull_request_id, min(commented_at) AS first_review_comment_at,
    count(DISTINCT comment_id) AS review_comment_count
  FROM v_rcomment WHERE pull_request_id IS NOT NULL AND comment_id IS NOT NULL GROUP BY 1, 2
), enriched AS (
  SELECT b.*, r.first_review_at, coalesce(r.review_count, 0) AS review_count,
    coalesce(r.approval_count, 0) AS approval_count, c.first_review_comment_at,
    coalesce(c.review_comment_count, 0) AS review_comment_count,
    (epoch(r.first_review_at) - epoch(b.opened_at)) / 3600.0 AS first_review_hours,
    (epoch(c.first_review_comment_at) - epoch(b.opened_at)) / 3600.0
      AS first_review_comment_hours,
    CASE WHEN r.first_review_at IS NULL THEN 0 ELSE 1 END AS reviewed_pr
  FROM pr_base b
  LEFT JOIN review_stats r
    ON b.repo_name = r.repo_name AND b.pull_request_id = r.pull_request_id
  LEFT JOIN comment_stats c
    ON b.repo_name = c.repo_name AND b.pull_request_id = c.pull_request_id
), opening AS (
  SELECT *, (epoch(opened_at) - epoch(prev_opened_at)) / 3600.0 AS pr_gap_hours FROM (
    SELECT *, lag(opened_at) OVER w AS prev_opened_at,
      count(*) OVER f AS rolling_pr_count_50,
      avg(first_review_hours) OVER f AS rolling_avg_first_review_hours_50
    FROM enriched
    WINDOW w AS (PARTITION BY repo_name ORDER BY opened_at, pull_request_id),
      f AS (PARTITION BY repo_name ORDER BY opened_at, pull_request_id
            ROWS BETWEEN 50 PRECEDING AND CURRENT ROW))
), windowed AS (
  SELECT *,
    row_number() OVER (PARTITION BY repo_name
      ORDER BY first_review_hours ASC NULLS LAST, pull_request_id) AS repo_review_speed_rank,
    percent_rank() OVER (PARTITION BY repo_name
      ORDER BY first_review_hours ASC NULLS LAST) AS repo_review_speed_percent_rank,
    row_number() OVER (PARTITION BY repo_name, dt
      ORDER BY first_review_hours ASC NULLS LAST, pull_request_id) AS daily_review_speed_rank
  FROM opening
)"""


def _seconds(column: str) -> str:
    return f"CAST(epoch({column}) AS BIGINT) AS {column}"


def _six(*columns: str) -> str:
    return ", ".join(f"{_half_up(column)} AS {column}" for column in columns)


_PR_BASE_COLUMNS = (
    f"repo_name, pull_request_id, dt, {_seconds('opened_at')}, {_seconds('merged_at')}, "
    "pull_request_merged, commit_count, additions, deletions, changed_files"
)
_OPENING_COLUMNS = _six("pr_gap_hours", "rolling_avg_first_review_hours_50")
_RANK_COLUMNS = (
    "repo_review_speed_rank, daily_review_speed_rank, " + _six("repo_review_speed_percent_rank")
)


def _latency(start: str, end: str) -> str:
    def mean(column: str, name: str | None = None) -> str:
        return f"{_half_up(f'avg({column})')} AS {name or 'avg_' + column}"

    def total(column: str, name: str) -> str:
        return f"CAST(sum({column}) AS BIGINT) AS {name}"

    measures = ", ".join(
        [
            "count(DISTINCT pull_request_id) AS pr_count",
            total("reviewed_pr", "reviewed_pr_count"),
            mean("first_review_hours"),
            f"{_half_up('quantile_disc(first_review_hours, 0.9)')} AS p90_first_review_hours",
            f"{_half_up('quantile_disc(first_review_hours, 0.95)')} AS p95_first_review_hours",
            mean("first_review_comment_hours"),
            mean("review_count"),
            mean("review_comment_count"),
            total("review_comment_count", "total_review_comment_count"),
            total("approval_count", "total_approval_count"),
            mean("repo_review_speed_rank"),
            "quantile_disc(repo_review_speed_rank, 0.9) AS p90_repo_review_speed_rank",
            mean("repo_review_speed_percent_rank"),
            mean("daily_review_speed_rank"),
            mean("pr_gap_hours"),
            mean("rolling_pr_count_50"),
            "max(rolling_pr_count_50) AS max_rolling_pr_count_50",
            mean("rolling_avg_first_review_hours_50", "avg_rolling_first_review_hours_50"),
        ]
    )
    return (
        f"SELECT dt, repo_name, {measures}, DATE '{start}' AS start_dt, DATE '{end}' AS end_dt "
        "FROM windowed GROUP BY dt, repo_name"
    )


def _pr(select: str) -> str:
    return _with(_ORDERS_PR, _PR_STATS, select=select)


# --- drift -------------------------------------------------------------------------------

_CHECKED = ", ".join(f"'{name}'" for name in CHECKED_TRACKS)


def _observed(extra: str = "TRUE") -> str:
    return f"""observed AS (
  SELECT * FROM (SELECT {_TRACK} AS track, dt, {_select(_VERDICT)} FROM facts
    WHERE {IS_VALID} AND {extra}) WHERE track IN ({_CHECKED})
), variants AS (
  SELECT track, dt, payload_variant, count(*) AS variant_rows FROM observed
  WHERE payload_variant <> 'parse_fail' GROUP BY 1, 2, 3
), registry AS (
  SELECT track, payload_variant, min(dt) AS first_seen_dt FROM variants
  WHERE dt < DATE '{rules.DRIFT_DAY}' GROUP BY 1, 2
), current_variants AS (SELECT * FROM variants WHERE dt >= DATE '{rules.DRIFT_DAY}')"""


def _is_known(scope: str) -> str:
    same_track = "r.track = v.track AND " if scope == "track" else ""
    return f"EXISTS (FROM registry r WHERE {same_track}r.payload_variant = v.payload_variant)"


_HEALTH = """SELECT track, dt, count(*) AS total_records,
  count(*) FILTER (WHERE NOT payload_parse_ok) AS parse_failure_count,
  count(*) FILTER (WHERE payload_corrupt) AS corrupt_count,
  count(*) FILTER (WHERE NOT payload_parse_ok) / count(*) AS parse_failure_rate
  FROM observed GROUP BY 1, 2"""


def _verdicts(days: str, firsts: str) -> str:
    """Verdict rows of the days, with ``firsts`` saying when each variant was first seen."""
    return f"""health AS ({_HEALTH}
), dated AS (
  SELECT v.*, f.first_seen_dt FROM variants v JOIN ({firsts}) f
    ON v.track = f.track AND v.payload_variant = f.payload_variant
), shown AS (
  SELECT track, dt,
    count(*) FILTER (WHERE dt = first_seen_dt) AS new_variant_count,
    count(*) FILTER (WHERE dt > first_seen_dt) AS known_variant_count,
    array_to_string(list_slice(
      list(payload_variant ORDER BY payload_variant) FILTER (WHERE dt = first_seen_dt),
      1, 3), ', ') AS sample
  FROM dated GROUP BY 1, 2
), expected AS (
  SELECT d.dt, t.track FROM ({days}) d, (SELECT unnest([{_CHECKED}]) AS track) t
), judged AS (
  SELECT track, dt, coalesce(total_records, 0) AS total_records,
    coalesce(parse_failure_count, 0) AS parse_failure_count,
    coalesce(corrupt_count, 0) AS corrupt_count,
    coalesce(parse_failure_rate, 0.0) AS rate,
    coalesce(new_variant_count, 0) AS new_variant_count,
    coalesce(known_variant_count, 0) AS known_variant_count, sample
  FROM expected LEFT JOIN health USING (track, dt) LEFT JOIN shown USING (track, dt)
), verdicts AS (
  SELECT track, dt, total_records, parse_failure_count, corrupt_count,
    {_half_up('rate', 4)} AS parse_failure_rate, new_variant_count, known_variant_count,
    total_records > 0 AND (rate >= 0.05 OR new_variant_count >= 1) AS drift_detected,
    concat_ws('; ',
      CASE WHEN total_records = 0 THEN 'no data' END,
      CASE WHEN total_records > 0 AND rate >= 0.05 THEN 'parse failure rate '
        || printf('%.2f%%', {_half_up('rate * 100', 2)}) || ' >= threshold 5.00%' END,
      CASE WHEN total_records > 0 AND new_variant_count >= 1
        THEN new_variant_count || ' new variants: ' || sample END) AS drift_reasons
  FROM judged
), daily AS (
  SELECT dt, bool_or(drift_detected) AS drift_detected,
    CAST(sum(new_variant_count) AS BIGINT) AS total_new_variants,
    max(parse_failure_rate) AS max_failure_rate,
    coalesce(array_to_string(
      list(track ORDER BY track) FILTER (WHERE drift_detected), ','), '') AS affected_tracks
  FROM verdicts GROUP BY dt
)"""


_BACKFILL = (
    _FACTS,
    _observed(),
    _verdicts(
        "SELECT DISTINCT dt FROM observed",
        "SELECT track, payload_variant, min(dt) AS first_seen_dt FROM variants GROUP BY 1, 2",
    ),
)
_DAY_BEFORE = f"DATE '{rules.DRIFT_DAY}' - INTERVAL 1 DAY"
_TWO_DAYS = (
    f"NOT ({IS_LATE}) AND dt BETWEEN CAST({_DAY_BEFORE} AS DATE) AND DATE '{rules.DRIFT_DAY}'"
)
_TWO_RUNS = (
    _FACTS,
    _observed(_TWO_DAYS),
    _verdicts(
        f"SELECT DATE '{rules.DRIFT_DAY}' AS dt",
        "SELECT track, payload_variant, min(dt) AS first_seen_dt FROM variants GROUP BY 1, 2",
    ),
)

# --- bookkeeping -------------------------------------------------------------------------

_MANIFEST = """manifest AS (
  SELECT dt, CAST(h AS INTEGER) AS hour_of_day,
    strftime(dt, '%Y-%m-%d-') || h || '.json.gz' AS source_name,
    'bronze/' || strftime(dt, '%Y/%m/%d/%Y-%m-%d-') || h || '.json.gz' AS landing_key
  FROM (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS dt
        FROM (SELECT CAST(min(dt) AS TIMESTAMP) AS first, CAST(max(dt) AS TIMESTAMP) AS last
              FROM facts)),
    (SELECT unnest(generate_series(0, 23)) AS h)
), landed AS (
  SELECT split_part(source_file, '/', 5) AS source_name,
    CAST(sum(length(raw_json)) AS BIGINT) AS bytes
  FROM raw GROUP BY 1
)"""
_STATUS = f"""statuses AS (
  SELECT m.source_name, coalesce(l.bytes, 0) AS bytes,
    CASE WHEN l.source_name < '{rules.DRIFT_DAY}' THEN 'skipped' WHEN l.bytes > 0 THEN 'ok'
      ELSE 'failed' END AS status
  FROM manifest m LEFT JOIN landed l ON m.source_name = l.source_name)"""

# --- silver and gold as the jobs write them ----------------------------------------------

_SILVER = f"silver AS (SELECT * FROM facts WHERE {IS_VALID} AND NOT ({IS_LATE}))"
_SILVER_EVENTS = f"""s_events AS (
  SELECT dt, {rules.REPO_NAME} AS repo_name, login AS actor_login, kind AS event_type
  FROM silver)"""
_SILVER_PUSHES = f"""s_push AS (
  SELECT dt, {_if_payload({'x': rules.PUSH_REF})['x']} AS ref
  FROM silver WHERE kind = 'PushEvent')"""


def _over_events(select: str) -> str:
    return _with(_FACTS, _EVENTS, select=select)


#: The lake holds the days that the lines span.
_SPAN = "(SELECT min(dt) FROM facts) AS start_dt, (SELECT max(dt) FROM facts) AS end_dt"


def _over_silver(select: str) -> str:
    select = select.replace(_JANUARY, _SPAN)
    return _with(_FACTS, _SILVER, _SILVER_EVENTS, _SILVER_PUSHES, select=select)


def _over_raw(select: str) -> str:
    return _with(_FACTS, _RAW, select=select)


def all_oracles() -> dict[str, str]:
    repos = ("repo_name", "repo_event_count", "count(*)", 10)
    types = ("event_type", "event_count", "count(*)", 20)
    top_repos, top_actors = _top("v_events", *repos), _top("v_events", *_ACTORS_BY_EVENTS)
    by_repos = _top("v_events", *_ACTORS_BY_REPOS)
    fault = f"CASE WHEN {IS_READABLE} THEN NULL ELSE fault END"
    observed = (_FACTS, _observed())
    silver_repos = _top("s_events", *repos)
    silver_actors = _top("s_events", *_ACTORS_BY_EVENTS)
    oracles = {
        "scan_events_range": _over_events(
            "SELECT * FROM v_events WHERE dt BETWEEN DATE '2024-01-08' AND DATE '2024-01-23'"
        ),
        "actor_filter": _over_events(f"SELECT * FROM v_events WHERE {_KNOWN}"),
        "date_range_stamp": _over_events(f"SELECT event_id, {_JANUARY} FROM v_events"),
        "repo_counts": _over_events(
            "SELECT repo_name, count(*) AS repo_event_count FROM v_events GROUP BY 1"
        ),
        "actor_counts": _over_events(
            "SELECT actor_login, count(*) AS actor_event_count FROM v_events "
            f"WHERE {_KNOWN} GROUP BY 1"
        ),
        "actor_distinct_repos": _over_events(
            "SELECT actor_login, count(DISTINCT repo_name) AS actor_repo_count FROM v_events "
            f"WHERE {_KNOWN} GROUP BY 1"
        ),
        "daily_repo_counts": _over_events(
            "SELECT dt, repo_name, count(*) AS event_count FROM v_events GROUP BY 1, 2"
        ),
        "event_type_counts": _over_events(
            "SELECT event_type, count(*) AS event_count FROM v_events GROUP BY 1"
        ),
        "top_repos": _over_events(_stamped(top_repos)),
        "top_repos_from_raw": _with(
            _FACTS,
            f"valid AS (SELECT {rules.REPO_NAME} AS repo_name FROM facts WHERE {IS_VALID})",
            select=_stamped(_top("valid", *repos)),
        ),
        "top_event_types": _over_events(_stamped(_top("v_events", *types))),
        "top_actors": _over_events(_stamped(top_actors)),
        "top_actors_distinct_repo": _over_events(_stamped(by_repos)),
        "repo_dim": _over_events(top_repos),
        "actor_dim": _over_events(top_actors),
        "top_repo_event_types": _over_events(
            _breakdown("v_events", top_repos, "repo_name", "repo_event_count")
        ),
        "top_actor_event_types": _over_events(
            _breakdown("v_events", top_actors, "actor_login", "actor_event_count")
        ),
        "top_actor_event_types_distinct_repo": _over_events(
            _breakdown("v_events", by_repos, "actor_login", "actor_repo_count")
        ),
        "daily_top_repos": _over_events(_daily_top("v_events")),
        "push_branch_groups": _with(_FACTS, _PUSHES, select=_BRANCHES.format(base="v_push")),
        "push_branch_ratio": _with(_FACTS, _PUSHES, select=_branch_ratio("v_push")),
        "bronze_lines": _over_raw("SELECT raw_json, TRUE AS has_source FROM raw"),
        "bronze_day": _over_raw(
            f"SELECT raw_json, '{rules.DRIFT_DAY.replace('-', '/')}' AS folder FROM raw "
            f"WHERE source_file LIKE 'archive/{rules.DRIFT_DAY.replace('-', '/')}/%'"
        ),
        "bronze_hour": _over_raw(
            f"SELECT raw_json, split_part(source_file, '/', 5) AS source_name FROM raw WHERE "
            f"CAST(file_ts AS DATE) = DATE '{rules.DRIFT_DAY}' AND hour(file_ts) = (SELECT "
            f"min(hour(file_ts)) FROM raw WHERE CAST(file_ts AS DATE) = DATE '{rules.DRIFT_DAY}')"
        ),
        "envelope_parse": _over_raw(
            "SELECT CAST(e AS VARCHAR) AS event_id, kind AS event_type, created_at, "
            "payload_text AS payload_raw, fault = 'wrong type' AS is_corrupt "
            f"FROM raw WHERE {IS_READABLE}"
        ),
        "invalid_rows": _over_raw(
            f"SELECT raw_json, source_file, {fault} AS fault FROM raw WHERE NOT ({IS_READABLE})"
        ),
        "invalid_sample": _over_raw(
            f"SELECT raw_json, source_file, {fault} AS fault FROM raw WHERE NOT ({IS_READABLE}) "
            "ORDER BY source_file, raw_json LIMIT 5"
        ),
        "events_normalized": _with(
            _FACTS,
            select="SELECT CAST(e AS VARCHAR) AS event_id, created_at, "
            f"{_SHARED['created_at_ts']} AS created_at_ts, dt FROM facts WHERE {IS_VALID}",
        ),
        "events_base": _over_raw(f"SELECT {_select(_BASE_COLUMNS)} FROM raw WHERE {IS_VALID}"),
        "events_base_own_day": _with(
            _FACTS,
            select="SELECT CAST(e AS VARCHAR) AS event_id, dt, source_file FROM facts "
            f"WHERE {IS_VALID} AND NOT ({IS_LATE})",
        ),
        **{
            f"track_{name.removeprefix('events_')}": _track_sql(name)
            for name in (*_TRACK_KIND, "push_commits")
        },
        "payload_variant": _with(
            _FACTS,
            _COMMITS,
            select=f"SELECT track, payload_variant, count(*) AS rows FROM ("
            f"SELECT {_TRACK} AS track, {_VERDICT['payload_variant']} AS payload_variant "
            f"FROM facts WHERE {IS_VALID} UNION ALL "
            f"SELECT 'push_commits', {_VERDICT['payload_variant']} FROM commits) GROUP BY 1, 2",
        ),
        "type_profile": _with(
            _FACTS,
            select="SELECT kind AS event_type, count(*) AS count FROM facts "
            f"WHERE {IS_VALID} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
        ),
        "track_profile": _with(
            _FACTS,
            _COMMITS,
            select="SELECT track, coalesce(rows, 0) AS rows, coalesce(payload_ok, 0) AS payload_ok FROM "
            f"(SELECT unnest({[*_TRACK_KIND, 'push_commits']}) AS track) LEFT JOIN (SELECT track, count(*) AS rows, "
            "count(*) FILTER (WHERE payload_parse_ok) AS payload_ok FROM ("
            f"SELECT {_TRACK} AS track, {_VERDICT['payload_parse_ok']} AS payload_parse_ok FROM facts "
            f"WHERE {IS_VALID} UNION ALL SELECT 'push_commits', {_VERDICT['payload_parse_ok']} "
            "FROM commits) GROUP BY 1) USING (track)",
        ),
        "day_preview": _over_raw(
            "SELECT dt, event_id, event_type, repo_name, actor_login, created_at_ts FROM "
            f"(SELECT {_select(_BASE_COLUMNS)} FROM raw WHERE {IS_VALID}) "
            f"WHERE dt = DATE '{rules.DRIFT_DAY}' ORDER BY created_at_ts, event_id LIMIT 20"
        ),
        "pr_base": _pr(f"SELECT {_PR_BASE_COLUMNS} FROM pr_base"),
        "pr_review_stats": _pr(
            f"SELECT repo_name, pull_request_id, {_seconds('first_review_at')}, review_count, "
            "approval_count FROM review_stats"
        ),
        "pr_review_comment_stats": _pr(
            f"SELECT repo_name, pull_request_id, {_seconds('first_review_comment_at')}, "
            "review_comment_count FROM comment_stats"
        ),
        "pr_enriched": _pr(
            f"SELECT {_PR_BASE_COLUMNS}, {_seconds('first_review_at')}, "
            f"{_seconds('first_review_comment_at')}, review_count, approval_count, "
            "review_comment_count, reviewed_pr, "
            f"{_six('first_review_hours', 'first_review_comment_hours')} FROM enriched"
        ),
        "pr_gap_lag": _pr(
            f"SELECT repo_name, pull_request_id, {_seconds('prev_opened_at')}, "
            f"{_six('pr_gap_hours')} FROM opening"
        ),
        "pr_rolling": _pr(
            "SELECT repo_name, pull_request_id, rolling_pr_count_50, "
            f"{_six('rolling_avg_first_review_hours_50')} FROM opening"
        ),
        "pr_speed_rank": _pr(
            f"SELECT repo_name, pull_request_id, {_RANK_COLUMNS} FROM windowed"
        ),
        "pr_windows_split": _pr(
            "SELECT repo_name, pull_request_id, rolling_pr_count_50, "
            f"{_OPENING_COLUMNS}, {_RANK_COLUMNS} FROM windowed"
        ),
        "pr_review_latency": _pr(_latency("1990-01-01", "2010-12-31")),
        "pr_review_latency_split": _pr(_latency("1990-01-01", "2010-12-31")),
        "drift_parse_rate": _with(
            *observed,
            select="SELECT track, dt, total_records, parse_failure_count, corrupt_count, "
            f"{_six('parse_failure_rate')} FROM ({_HEALTH})",
        ),
        "drift_variants": _with(*observed, select="SELECT * FROM variants"),
        "drift_new": _with(
            *observed, select=f"SELECT * FROM current_variants v WHERE NOT {_is_known('track')}"
        ),
        "drift_new_global": _with(
            *observed, select=f"SELECT * FROM current_variants v WHERE NOT {_is_known('global')}"
        ),
        "drift_labels": _with(
            *observed,
            select=f"SELECT *, NOT {_is_known('track')} AS is_new FROM current_variants v",
        ),
        "drift_known": _with(
            *observed, select=f"SELECT * FROM current_variants v WHERE {_is_known('track')}"
        ),
        "registry_merge": _with(
            *observed,
            select="SELECT track, payload_variant, min(dt) AS first_seen_dt FROM variants "
            "GROUP BY 1, 2",
        ),
        "drift_tracks": _with(*_BACKFILL, select="SELECT * FROM verdicts"),
        "drift_daily": _with(*_BACKFILL, select="SELECT * FROM daily"),
        "drift_history": _with(
            *_BACKFILL,
            select="SELECT *, CAST(epoch(CAST(dt AS TIMESTAMP)) AS BIGINT) AS recorded_at "
            "FROM daily ORDER BY dt DESC LIMIT 100",
        ),
        "hour_manifest": _with(_FACTS, _RAW, _MANIFEST, select="SELECT * FROM manifest"),
        "missing_hours": _with(
            _FACTS,
            _RAW,
            _MANIFEST,
            select="SELECT * FROM manifest m WHERE NOT EXISTS "
            "(FROM landed l WHERE l.source_name = m.source_name "
            f"AND l.source_name < '{rules.DRIFT_DAY}')",
        ),
        "ingest_status": _with(
            _FACTS, _RAW, _MANIFEST, _STATUS, select="SELECT * FROM statuses"
        ),
        "ingest_summary": _with(
            _FACTS,
            _RAW,
            _MANIFEST,
            _STATUS,
            select="SELECT status, count(*) AS hours FROM statuses GROUP BY 1",
        ),
        "landed_hours": _over_raw(
            "SELECT DISTINCT split_part(source_file, '/', 5) AS source_name, TRUE AS has_bytes FROM raw"
        ),
        "landed_summary": _with(
            _FACTS,
            _RAW,
            _MANIFEST,
            select=f"SELECT CASE WHEN l.source_name < '{rules.DRIFT_DAY}' THEN 'skipped' "
            "WHEN l.source_name IS NULL THEN 'failed' ELSE 'ok' END AS status, count(*) AS hours "
            "FROM manifest m LEFT JOIN landed l ON m.source_name = l.source_name GROUP BY 1",
        ),
        "silver_report": _with(
            _FACTS,
            select="SELECT unnest(['lines', 'faulty', 'dropped', 'other_day', 'kept']) AS measure, "
            f"unnest([count(*), count(*) FILTER (WHERE NOT ({IS_READABLE})), "
            "count(*) FILTER (WHERE fault = 'bad time'), "
            f"count(*) FILTER (WHERE {IS_VALID} AND {IS_LATE}), "
            f"count(*) FILTER (WHERE {IS_VALID} AND NOT ({IS_LATE}))]) AS lines FROM facts",
        ),
        "silver_rows": _with(
            _FACTS,
            _SILVER,
            _COMMITS,
            select="SELECT dataset, dt, count(*) AS rows, TRUE AS has_files, TRUE AS has_bytes "
            f"FROM (SELECT 'events_base' AS dataset, dt FROM silver UNION ALL "
            f"SELECT {_TRACK}, dt FROM silver UNION ALL "
            f"SELECT 'push_commits', dt FROM commits WHERE NOT ({IS_LATE})) GROUP BY 1, 2",
        ),
        "output_audit": _with(
            _FACTS,
            _SILVER,
            _COMMITS,
            select="SELECT dataset, dt, coalesce(rows, 0) AS rows, rows IS NULL AS missing, "
            "rows IS NOT NULL AS has_files, rows IS NOT NULL AS has_bytes FROM "
            f"(SELECT unnest({['events_base', *_TRACK_KIND, 'push_commits']}) AS dataset) CROSS JOIN "
            "(SELECT CAST(unnest(generate_series(min(dt) - INTERVAL 1 DAY, max(dt) + INTERVAL 1 DAY, "
            "INTERVAL 1 DAY)) AS DATE) AS dt FROM facts) LEFT JOIN (SELECT dataset, dt, count(*) AS rows "
            f"FROM (SELECT 'events_base' AS dataset, dt FROM silver UNION ALL "
            f"SELECT {_TRACK}, dt FROM silver UNION ALL "
            f"SELECT 'push_commits', dt FROM commits WHERE NOT ({IS_LATE})) GROUP BY 1, 2) "
            "USING (dataset, dt)",
        ),
        "silver_days": _with(
            _FACTS,
            _SILVER,
            select=f"SELECT dt, {rules.REPO_NAME} AS repo_name, login AS actor_login, "
            "kind AS event_type, CAST(e AS VARCHAR) AS event_id FROM silver WHERE dt BETWEEN "
            f"DATE '{rules.DRIFT_DAY}' - INTERVAL 1 DAY AND DATE '{rules.DRIFT_DAY}' + INTERVAL 1 DAY",
        ),
        "silver_track_day": _with(
            _FACTS,
            _SILVER,
            select=f"SELECT dt, CAST(e AS VARCHAR) AS event_id, {rules.REPO_NAME} AS repo_name, "
            f"{_VERDICT['payload_variant']} AS payload_variant, "
            f"coalesce({_old_push('e % 3')}, 0) AS commit_count "
            f"FROM silver WHERE kind = 'PushEvent' AND dt = DATE '{rules.DRIFT_DAY}'",
        ),
        "gold_top_repos": _over_silver(_stamped(silver_repos)),
        "gold_event_type_counts": _over_silver(_stamped(_top("s_events", *types))),
        "gold_top_repo_event_types": _over_silver(
            _breakdown("s_events", silver_repos, "repo_name", "repo_event_count")
        ),
        "gold_top_actors": _over_silver(_stamped(silver_actors)),
        "gold_top_actor_event_types": _over_silver(
            _breakdown("s_events", silver_actors, "actor_login", "actor_event_count")
        ),
        "gold_daily_top_repos": _over_silver(_daily_top("s_events")),
        "gold_push_branch_ratio": _over_silver(_branch_ratio("s_push")),
        "gold_pull_request_review_latency": _with(
            _FACTS,
            _SILVER,
            _SILVER_PR,
            _PR_STATS,
            select=_latency("2024-01-01", "2024-01-31").replace(_JANUARY, _SPAN),
        ),
        "gold_csv_top_repos": _over_silver(_stamped(silver_repos)),
        "drift_job_results": _with(
            *_TWO_RUNS, select="SELECT *, (SELECT count(*) FROM verdicts) AS tracks FROM daily"
        ),
        "drift_job_history": _with(*_TWO_RUNS, select="SELECT *, TRUE AS recorded FROM daily"),
        "drift_job": _with(*_TWO_RUNS, select="SELECT * FROM verdicts"),
        "drift_job_registry": _with(
            _FACTS,
            _observed(_TWO_DAYS),
            select="SELECT track, payload_variant, min(dt) AS first_seen_dt, "
            "CAST(3 AS BIGINT) AS version FROM variants GROUP BY 1, 2",
        ),
    }
    # The same hours are missing whether they are told by lines or by a listing.
    return oracles | {"landed_missing_hours": oracles["missing_hours"]}
