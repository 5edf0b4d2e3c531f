"""Sharding by weighted rendezvous hashing.

Every shard draws a number from (record key, shard number); the highest score -weight / ln(u)
takes the record. A shard's draw does not depend on the other shards, so a new one takes
records from all of them in proportion to its weight and none moves between the old ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import keyed, whole
from strata.session import materialize

#: Groups within a shard that are numbered side by side.
BUCKETS = 256
LAW = "key"


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard that takes the key; equal scores go to the larger number."""

    def scored(shard: int, weight: float) -> Column:
        draw = F.xxhash64(key, F.lit(shard))
        unit = (F.shiftrightunsigned(draw, 11) + F.lit(0.5)) / F.lit(float(2**53))
        return F.struct(
            (F.lit(-float(weight)) / F.ln(unit)).alias("score"), F.lit(shard).alias("shard")
        )

    scores = [scored(shard, weight) for shard, weight in enumerate(weights) if weight > 0]
    if not scores:
        raise ValueError("no shard has a weight above 0")
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return best["shard"]


def numbered(rows: DataFrame, shard: str, key: str) -> DataFrame:
    """Adds ``slot``: 0, 1, 2 ... within each shard.

    A shard is numbered in ``BUCKETS`` parts by hash of the key; the parts' sizes (shards x
    buckets rows, whatever the input) give where each part starts. No task holds a shard.
    """
    parted = rows.withColumn("_part", F.pmod(F.xxhash64(F.col(key), F.lit("slot")), F.lit(BUCKETS)))
    return rows.sparkSession.sql(
        f"""
        WITH sizes AS (
            SELECT {shard}, _part, count(*) AS n FROM {{parted}} GROUP BY {shard}, _part
        ), starts AS (
            SELECT {shard} AS s, _part AS p,
                sum(n) OVER (PARTITION BY {shard} ORDER BY _part) - n AS first
            FROM sizes
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY {shard}, _part ORDER BY {key}) - 1 AS _rank
            FROM {{parted}}
        )
        SELECT ranked.* EXCEPT (_part, _rank), CAST(first + _rank AS BIGINT) AS slot
        FROM ranked JOIN starts ON {shard} = s AND _part = p
        """,
        parted=parted,
    )


def assign_shards(
    docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard) for every row of ``docs``.

    The document id and the weights decide the shard; ``grown`` are the weights after a
    change. Rows that share an id share the shard, a null id is a key like any other, a null
    text has no bytes. Slots are gapless from 0 in every shard and follow the key's hash and
    the key. Only id and text are read; an empty table gives an empty table.
    """
    text = whole("text")
    placed = keyed(docs, "doc_id", "text").select(
        "_key",
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        (rendezvous(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    return numbered(materialize(placed, "placed"), "shard", "_key").drop("_key")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float]) -> None:
    """The whole rows, one folder for each shard; large shards get several files."""
    placed = docs.withColumn("shard", rendezvous(F.col("doc_id"), weights))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
