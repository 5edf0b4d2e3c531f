"""Line dedup: lines that many documents hold stay in one of them only.

Lines are exploded and hashed (MD5 of the normalised line), documents are counted per hash,
and the positions to drop come back as one sorted array per document, from which the text is
put together again in the order of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, ascii_lower, keyed, whole
from strata.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3


def _lines(text: Column) -> Column:
    return F.split(whole(text), "\n", -1)


def _flags(positions: Column) -> Column:
    """Sorted positions as booleans by position: linear in the number of lines."""
    before = F.concat(F.array(F.lit(-1)), F.slice(positions, 1, F.size(positions) - 1))
    run = F.zip_with(
        positions,
        before,
        lambda at, last: F.concat(
            F.array_repeat(F.lit(False), at - last - 1), F.array(F.lit(True))
        ),
    )
    return F.flatten(run)


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_key, positions) of the lines to drop; ``docs`` has _key and text.

    Counts are combined before each shuffle. A line that a third of all documents hold is a
    skewed join key with one row on the other side, which adaptive execution splits.
    """
    exploded = docs.select("_key", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    line = F.btrim(F.col("line"), F.lit(SPACES))
    long = exploded.select("_key", "pos", line.alias("line")).where(
        F.char_length("line") >= min_chars
    )
    hashed = materialize(
        long.select("_key", "pos", F.unhex(F.md5(ascii_lower(F.col("line")))).alias("h")), "lines"
    )
    spread = (
        hashed.select("h", "_key")
        .distinct()
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("docs"), F.max("_key").alias("last"))
        .where(F.col("docs") >= min_docs)
        .select("h", "last")
    )
    # Written, so that the join below reads both sides from plain shuffles, which can be split.
    spread = materialize(spread, "spread-lines")
    dropped = hashed.join(spread, "h").where(F.col("_key") != F.col("last"))
    return dropped.groupBy("_key").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def line_dedup(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): each document without its repeated lines.

    A line's key is the line stripped of white space, A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents lose all their lines except
    in the document of the largest id that holds them, where every repeat stays. Null and
    empty texts are one empty line. Rows that share an id, or have none, are documents of
    their own. Other columns of ``docs`` are not read; an empty table gives an empty table.
    """
    own = keyed(docs, "doc_id", "text")
    joined = own.join(repeated_lines(own, min_chars, min_docs), "_key", "left")
    lines = _lines(F.col("text"))
    flags = F.col("flags")
    kept = F.when(flags.isNull(), whole("text")).otherwise(
        F.array_join(
            F.filter(lines, lambda _, at: ~F.coalesce(F.get(flags, at), F.lit(False))), "\n"
        )
    )
    return joined.withColumn("flags", _flags(F.col("positions"))).select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
