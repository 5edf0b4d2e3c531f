"""The benchmark tables as archive lines, silver tables and pull requests, in Spark."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.events import events_base
from strata.session import materialize, scratch_path
from strata.sources import folders
from strata.workload import rules


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(**expressions: str) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in expressions.items()]


_LATE = "event_id % 127 = 0"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# The hour in whose file a line lies.
_FILE_TIME = f"CASE WHEN {_LATE} THEN ts + INTERVAL 1 DAY ELSE ts END"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of the archive, with the time text it carries and its file."""
    return _facts(table(spark, sf_dir, "events"))


def _facts(rows: DataFrame) -> DataFrame:
    event_time = "date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'')"
    return rows.selectExpr(
        *_columns(
            **rules.FACTS,
            created_at=f"CASE WHEN event_id % 103 = 0 AND event_id % 101 <> 0 AND event_id % 107 <> 0 "
            f"THEN replace({event_time}, 'Z', '.5Z') ELSE {event_time} END",
            source_file=f"'archive/' || date_format({_FILE_TIME}, 'yyyy/MM/dd/yyyy-MM-dd-H') || '.json.gz'",
        )
    )


_written: dict[tuple[str, str, str], DataFrame] = {}


def _at_rest(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A derived table, written once per session and table folder.

    Queries start from tables at rest, as they do on landed files and silver tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = materialize(build(), name)
    return _written[key]


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _splits(scan: DataFrame) -> int:
    """Splits of a plain scan. Not to be asked of a join: the answer would take its shuffles."""
    return scan.rdd.getNumPartitions()


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_json, source_file``: what a scan of the landed files gives.

    The lines of a file lie together: rows are dealt by its hour, before anything is derived.
    """

    def build() -> DataFrame:
        rows = table(spark, sf_dir, "events")
        by_hour = rows.repartitionByRange(
            max(_cores(spark), _splits(rows)), F.expr(f"date_trunc('hour', {_FILE_TIME})")
        )
        by_file = _facts(by_hour)
        lines = by_file.selectExpr("*", f"{rules.PAYLOAD_TEXT} AS payload_text")
        lines = lines.selectExpr("*", f"{rules.LINE} AS line")
        return lines.selectExpr(f"{rules.RAW_JSON} AS raw_json", "source_file")

    with _split_code(spark):
        return _at_rest(spark, sf_dir, "raw-lines", build)


@contextmanager
def _split_code(spark: SparkSession) -> Iterator[None]:
    """Expressions of this size make one method of generated code, too long for the JVM to
    compile. Below this limit Spark splits them into short ones."""
    before = spark.conf.get(_METHOD_LIMIT)
    spark.conf.set(_METHOD_LIMIT, "8000")
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


_archives: dict[tuple[str, str], str] = {}


def landed_archive(spark: SparkSession, sf_dir: str) -> str:
    """The root of the archive as hourly gzip files under their days' folders.

    Each hour's lines are written as one file by the task that has them, and then named.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _archives:
        staged, root = scratch_path(spark, "landing"), scratch_path(spark, "archive")
        lines = raw_lines(spark, sf_dir).selectExpr(
            "raw_json", "replace(replace(source_file, 'archive/', ''), '/', '_') AS file"
        )
        by_file = lines.repartition("file").write.partitionBy("file")
        by_file.option("compression", "gzip").text(staged)
        for folder in folders.names(spark, staged):
            if folder.startswith("file="):
                target = folder.removeprefix("file=").replace("_", "/")
                (part,) = (n for n in folders.names(spark, f"{staged}/{folder}") if n.endswith(".gz"))
                folders.rename(spark, f"{staged}/{folder}/{part}", f"{root}/{target}")
        _archives[key] = root
    return _archives[key]


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base events of the archive's lines, each file sorted as the silver job sorts it."""

    def build() -> DataFrame:
        return events_base(raw_lines(spark, sf_dir)).sortWithinPartitions("dt", "event_type")

    return _at_rest(spark, sf_dir, "events-base", build)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base event table as the marts read it, with the table's own event types."""
    return facts(spark, sf_dir).selectExpr(
        *_columns(
            dt="dt",
            repo_name=rules.REPO_NAME,
            actor_login="login",
            event_type="table_type",
            event_id="CAST(e AS STRING)",
        )
    )


def pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = facts(spark, sf_dir).where("kind = 'PushEvent'")
    return clicks.selectExpr("dt", f"{rules.REPO_NAME} AS repo_name", f"{rules.PUSH_REF} AS ref")


def _pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An opening event per order (status P: another action), and a closing one if merged."""
    orders = table(spark, sf_dir, "orders")
    shared = _columns(repo_name=rules.PR_REPO, pull_request_id="o_orderkey")
    first = orders.selectExpr(
        "CAST(o_orderdate AS DATE) AS dt",
        *shared,
        *_columns(
            created_at_ts="CAST(o_orderdate AS TIMESTAMP)",
            action="CASE WHEN o_orderstatus = 'P' THEN 'reopened' ELSE 'opened' END",
            pull_request_number="o_orderkey + 1",
            pull_request_merged="FALSE",
            pull_request_merged_at="CAST(NULL AS STRING)",
            commit_count="CAST(o_orderkey % 7 AS INT)",
            additions="CAST(o_orderkey % 501 AS INT)",
            deletions="CAST(o_orderkey % 97 AS INT)",
            changed_files="CAST(o_orderkey % 13 AS INT)",
        ),
    )
    merged_at = "date_format(o_orderdate + INTERVAL 3 DAY, 'yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'')"
    closing = orders.where("o_orderstatus = 'F'").selectExpr(
        "CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS dt",
        *shared,
        *_columns(
            created_at_ts="CAST(o_orderdate + INTERVAL 3 DAY AS TIMESTAMP)",
            action="'closed'",
            pull_request_number="o_orderkey + 1",
            pull_request_merged="TRUE",
            pull_request_merged_at=merged_at,
            commit_count="CAST(o_orderkey % 5 AS INT)",
            additions="CAST(o_orderkey % 777 AS INT)",
            deletions="CAST(o_orderkey % 31 AS INT)",
            changed_files="CAST(o_orderkey % 17 AS INT)",
        ),
    )
    both = first.unionByName(closing)
    # A table of few splits is spread; of many, a shuffle of the rows would gain nothing.
    return both if _splits(orders) >= _cores(spark) else both.repartition(_cores(spark))


def _reviewed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order's repository: reviews and comments are columns of it."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS pull_request_id", f"{rules.PR_REPO} AS repo_name"
    )
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS pull_request_id",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate + make_dt_interval(0, CAST(l_partkey % 24 AS INT)) AS at",
    )
    joined = lines.join(orders, "pull_request_id")
    spread = _splits(table(spark, sf_dir, "lineitem")) >= _cores(spark)
    return joined if spread else joined.repartition(_cores(spark))


def _reviewed_at_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one join behind reviews and review comments, made and written once."""
    return _at_rest(spark, sf_dir, "reviewed-lines", lambda: _reviewed_lines(spark, sf_dir))


_AT_TEXT = "date_format(at, 'yyyy-MM-dd\\'T\\'HH:mm:ss\\'Z\\'')"


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed_at_rest(spark, sf_dir).selectExpr(
        "CAST(at AS DATE) AS dt",
        "repo_name",
        "pull_request_id",
        *_columns(
            review_id="CASE WHEN l_partkey % 53 <> 0 THEN CAST(l_linenumber AS BIGINT) END",
            review_state="CASE l_returnflag WHEN 'A' THEN 'approved' "
            "WHEN 'R' THEN 'changes_requested' ELSE 'commented' END",
            review_submitted_at=_AT_TEXT,
        ),
    )


def review_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _reviewed_at_rest(spark, sf_dir)
        .where("l_linestatus = 'O'")
        .selectExpr(
            "CAST(at AS DATE) AS dt",
            "repo_name",
            "pull_request_id",
            "l_partkey AS comment_id",
            f"{_AT_TEXT} AS comment_created_at",
        )
    )


def pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_rest(spark, sf_dir, "pull-requests", lambda: _pull_requests(spark, sf_dir))
