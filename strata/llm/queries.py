"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    decontamination,
    embedding_dedup,
    fill_in_middle,
    html_extract,
    line_dedup,
    mixing,
    periodic_runs,
    quality,
    records,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
)
from strata.llm.common import table, whole
from strata.session import materialize

SHARDS = 24
TOKEN_LIMIT = 4096
END_ID = 2
PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def held_out() -> Column:
    """The fold that no score is learned from: a quarter of the ids, by CRC-32 of their text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(
        table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1)
    ).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", "grown_shard"
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), TOKEN_LIMIT, keep_tables=False
    )
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "fits_chars"
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumn(
        "probability", F.round("probability", 9)
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked_fingerprints(table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = records.new_folder(spark)
    index = records.write_records(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), END_ID
    )
    return records.record_digests(index, path)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~held_out()))
    return docs.select(
        "doc_id", held_out().alias("held_out"), quality.scored(model, docs["text"]).alias("score")
    ).withColumn("predicted", (F.col("score") >= quality.ACCEPTED).cast("int"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


#: What the query takes for a word of ``documents``, as a pattern.
WORD = r"[^\x20\x09-\x0D]+"


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by hash of the id, goes on periodically from some word on."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    words = F.regexp_extract_all(whole("text"), F.lit(WORD), F.lit(0))
    hashed = docs.select("doc_id", "text", F.crc32(key).alias("h"))
    g = F.floor(F.col("h") / 10)
    split = hashed.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words")
    placed = split.withColumn("a", F.when(n > 0, g % n)).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + g % 8))
    )
    a, p = F.col("a"), F.col("p")
    source = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.get("words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
    )
    planted = F.when(a.isNotNull(), F.array_join(source, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", planted.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    # Runs are in the order that breaks ties, so only a greater exponent takes the lead.
    leads = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(
            run["length"] * best["period"] > best["length"] * run["period"], run
        ).otherwise(best),
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    best = F.col("best")
    return found.withColumn("best", leads).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.col("kept_sha256").alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = materialize(
        fill_in_middle.compress_texts(table(spark, sf_dir, "documents")), "text-frames"
    )
    return fill_in_middle.digests(fill_in_middle.fill_in_middle(framed, seed=7))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_line_dedup,
        op2_sharding,
        op3_token_counts,
        op4_mixing,
        op5_simhash,
        op6_token_records,
        op7_decontamination,
        op8_quality,
        op9_embedding_dedup,
        op10_suffix_dedup,
        op11_periodic_runs,
        op12_fill_in_middle,
        op13_html_extraction,
    ]
    return {query.__name__: query for query in own}
