"""Raw JSON lines to the flat base event table."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import event_time
from strata.functions.schemas import CORRUPT, EVENT, EVENTS_BASE, STRING, with_corrupt

# The payload is declared as text, so one parse yields both the envelope and the
# payload's own JSON.
_LINE = with_corrupt(T.StructType([*EVENT.fields, T.StructField("payload", STRING, True)]))

# Base columns that come out of the envelope under another name.
ENVELOPE_COLUMNS = {
    "event_id": "id",
    "event_type": "type",
    "actor_id": "actor.id",
    "actor_login": "actor.login",
    "actor_display_login": "actor.display_login",
    "actor_gravatar_id": "actor.gravatar_id",
    "actor_url": "actor.url",
    "actor_avatar_url": "actor.avatar_url",
    "repo_id": "repo.id",
    "repo_name": "repo.name",
    "repo_url": "repo.url",
    "org_id": "org.id",
    "org_login": "org.login",
    "org_gravatar_id": "org.gravatar_id",
    "org_url": "org.url",
    "org_avatar_url": "org.avatar_url",
    "payload_raw": "payload",
}


#: What an event must have to be kept.
_NEEDED = ["created_at_ts", "dt", "id", "type"]


def parse_lines(raw: DataFrame) -> DataFrame:
    """``raw_json, source_file`` to one ``event`` struct per line, with the verdict ``fault``.

    ``fault`` is NULL for a readable line, ``blank`` where there is no JSON at all and
    ``malformed`` where no identifying field could be read. A line with one wrong-typed
    field stays readable: that field is NULL and the corrupt column holds the text.
    """
    event = F.from_json("raw_json", _LINE, {"columnNameOfCorruptRecord": CORRUPT})
    # Filters on event fields must not be pushed below the parse: they would parse the line
    # again for each of their terms. A one-element explode keeps them above it.
    parsed = raw.select("raw_json", "source_file", F.explode(F.array(event)).alias("event"))
    unidentified = F.coalesce("event.id", "event.type", "event.created_at").isNull()
    malformed = F.col(f"event.{CORRUPT}").isNotNull() & unidentified
    fault = F.when(F.col("event").isNull(), "blank").when(malformed, "malformed")
    return parsed.withColumn("fault", fault)


def readable_events(parsed: DataFrame) -> DataFrame:
    """Envelope fields as columns, payload text as ``payload``, of the lines without a fault."""
    return parsed.where("fault IS NULL").select("event.*", "source_file")


def quarantine(parsed: DataFrame) -> DataFrame:
    """The unreadable lines, verbatim, with the file they came from and the fault."""
    return parsed.where("fault IS NOT NULL").select("raw_json", "source_file", "fault")


def quarantine_sample(parsed: DataFrame, rows: int = 5) -> DataFrame:
    """A few unreadable lines for a log; ordered, so a rerun shows the same ones."""
    return quarantine(parsed).orderBy("source_file", "raw_json").limit(rows)


def normalize(events: DataFrame) -> DataFrame:
    """Add ``created_at_ts`` and ``dt``; drop events without time, id or type."""
    timed = events.withColumn("created_at_ts", event_time("created_at"))
    dated = timed.withColumn("dt", F.to_date("created_at_ts"))
    return dated.dropna(how="any", subset=_NEEDED)


def flatten(events: DataFrame, *more: str) -> DataFrame:
    """The base event table's 22 columns."""
    return events.select(
        *(
            F.col(ENVELOPE_COLUMNS.get(name, name)).alias(name)
            for name in EVENTS_BASE.fieldNames()
        ),
        *more,
    )


# What becomes of a line.
FAULTY, DROPPED, OTHER_DAY, KEPT = "faulty", "dropped", "other_day", "kept"
OUTCOMES = (FAULTY, DROPPED, OTHER_DAY, KEPT)


def judged(raw: DataFrame, wanted: Column) -> DataFrame:
    """A base row for every line, with its ``outcome``; rows not kept have no payload.

    An event is kept that normalisation keeps, of its file's own day and where ``wanted``.
    """
    lines = parse_lines(raw).select("event.*", "source_file", "fault")
    timed = lines.withColumn("created_at_ts", event_time("created_at"))
    dated = timed.withColumn("dt", F.to_date("created_at_ts"))
    lacks = reduce(or_, (F.col(name).isNull() for name in _NEEDED))
    own_day = F.coalesce((F.col("dt") == file_day()) & wanted, F.lit(False))
    outcome = (
        F.when(F.col("fault").isNotNull(), FAULTY)
        .when(lacks, DROPPED)
        .otherwise(F.when(own_day, KEPT).otherwise(OTHER_DAY))
    )
    told = dated.withColumn("outcome", outcome)
    slim = told.withColumn("payload", F.when(F.col("outcome") == KEPT, F.col("payload")))
    return flatten(slim, "outcome")


def events_base(raw: DataFrame) -> DataFrame:
    """Raw lines straight to base events of whatever day they carry."""
    return flatten(normalize(readable_events(parse_lines(raw))))


def file_day(source_file: Column | str = "source_file") -> Column:
    """The day a landed file is named after (``yyyy-MM-dd-H.json.gz``)."""
    return F.to_date(F.regexp_extract(source_file, r"(\d{4}-\d{2}-\d{2})-\d{1,2}\.json", 1))


def on_own_day(base: DataFrame) -> DataFrame:
    """Keep an event only in the day of its file; strays are dropped, never re-homed.

    Over several days this gives the rows that day-by-day runs would give.
    """
    return base.where(F.col("dt") == file_day())
