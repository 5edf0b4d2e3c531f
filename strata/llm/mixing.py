"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed by (source, language, topic) once. The table of these cells is raked
to the target share of every source, language and topic in turn. One scale for all cells then
meets a token budget: a cell keeps the scaled raked weight, or all it has where that is less.
A cell that is too small for its share so gives what it has and leaves the others alone; where
no cell is, expected tokens have the target shares exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import whole
from strata.session import materialize

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a value: its own share to this power. Below 1 small ones gain; at 1 the
#: shares are held, whatever the other dimensions do.
FLATTENING = {"source": 0.85, "lang": 0.9, "topic": 1.0}
ROUNDS = 8
#: Share of all tokens that is to be kept.
BUDGET = 0.8
#: Steps to the scale, each one an aggregate of the cells; some five are needed.
STEPS = 100
SHORT_WORDS = 100
LISTED_LINES = 20
SEED = "mix"


def words(text: Column) -> Column:
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+"))


def tokens(text: Column) -> Column:
    """Words, and the end of the document."""
    return (words(text) + 1).cast("long")


def form(text: Column, counted: Column | None = None) -> Column:
    """The topic where documents carry none: what kind of text it is, by its shape.

    ``counted`` is the number of its words where that is at hand.
    """
    lines = F.length(whole(text)) - F.length(F.replace(whole(text), F.lit("\n"), F.lit("")))
    n = words(text) if counted is None else counted
    return (
        F.when(n == 0, "empty")
        .when(lines >= LISTED_LINES, "listed")
        .when(n < SHORT_WORDS, "short")
        .otherwise("prose")
    )


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that the id and the seed decide."""
    digest = F.md5(F.concat_ws("-", F.lit(seed), doc_id.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _rake(cells: DataFrame, rounds: int) -> DataFrame:
    def over(name: str):
        return Window.partitionBy(name)

    marked = cells.withColumns(
        {
            f"to_{d}": F.pow(
                F.sum("tokens").over(over(d)).cast("double"), F.lit(FLATTENING[d])
            ) for d in DIMENSIONS
        }
    )
    if any(f"share_{d}" in cells.columns for d in DIMENSIONS):
        marked = marked.withColumns(
            {f"to_{d}": F.col(f"share_{d}") for d in DIMENSIONS if f"share_{d}" in cells.columns}
        )
    weighted = marked.withColumn("w", F.col("tokens").cast("double"))
    for d in DIMENSIONS * rounds:
        total = F.sum("w").over(over(d))
        weighted = weighted.withColumn(
            "w", F.when(total > 0, F.col("w") * F.col(f"to_{d}") / total).otherwise(0.0)
        )
    return weighted


def _scale(cells: DataFrame, budget: float) -> float:
    """The scale at which the cells, each kept up to all it has, sum to the budget.

    The sum grows with the scale and bends down where a cell is used up. Steps along its
    slope go up to the answer and stop there: only two numbers come to the driver in each.
    """
    used_up = F.col("tokens") <= F.col("w") * F.col("scale")
    scale = 0.0
    for _ in range(STEPS):
        kept, slope = (
            cells.withColumn("scale", F.lit(scale))
            .agg(
                F.sum(F.when(used_up, F.col("tokens").cast("double")).otherwise(0.0)),
                F.sum(F.when(used_up, 0.0).otherwise(F.col("w"))),
            )
            .first()
        )
        if not slope:
            return scale
        step = (budget - kept) / slope
        if step <= scale * (1 + 1e-12):
            return max(scale, step)
        scale = step
    return scale


def convergence(cells: DataFrame) -> DataFrame:
    """(dimension, error): the largest relative distance of a raked sum from its target.

    ``cells`` are those of ``raked``. The dimension that was raked last has none; targets
    that contradict each other leave an error however many rounds there are.
    """
    parts = []
    for d in DIMENSIONS:
        sums = cells.groupBy(d).agg(F.sum("w").alias("w"), F.max(f"to_{d}").alias("target"))
        # Sums of different dimensions differ by a factor: shares are compared.
        whole_w, whole_target = (F.sum(c).over(Window.partitionBy(F.lit(1))) for c in ("w", "target"))
        share, aim = F.col("w") / whole_w, F.col("target") / whole_target
        off = sums.where("target > 0").select((F.abs(share - aim) / aim).alias("off"))
        parts.append(off.agg(F.lit(d).alias("dimension"), F.max("off").alias("error")))
    return reduce(DataFrame.union, parts)


def facts(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, tokens); ``topic`` defaults to the text's form."""
    text = docs["text"]
    own = docs.select(
        docs["doc_id"],
        docs["source"],
        docs["lang"],
        (text if topic is None else topic).alias("_about"),
        words(text).alias("_words"),
    )
    shape = form(F.col("_about"), F.col("_words")) if topic is None else F.col("_about")
    return own.select(
        "doc_id",
        "source",
        "lang",
        shape.alias("topic"),
        (F.col("_words") + 1).cast("long").alias("tokens"),
    )


def raked(
    rows: DataFrame, targets: dict[str, dict[str, float]] | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """(source, lang, topic, tokens, w, to_source, to_lang, to_topic) of every cell.

    ``w`` is the raked weight. ``targets`` gives shares for the values of some dimensions (a
    value without share gets none); other dimensions aim at their own shares flattened. The
    result is written and read back. Null is a value like any other.
    """
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    for d, shares in (targets or {}).items():
        known = [F.when(F.col(d) == value, F.lit(float(share))) for value, share in shares.items()]
        cells = cells.withColumn(f"share_{d}", F.coalesce(*known, F.lit(0.0)))
    columns = [*DIMENSIONS, "tokens", "w", *(f"to_{d}" for d in DIMENSIONS)]
    return materialize(_rake(cells, rounds).select(*columns), "cells")


def probabilities(
    rows: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    budget: float = BUDGET,
) -> DataFrame:
    """(source, lang, topic, tokens, probability) of every cell of ``facts`` rows.

    Expected tokens add up to ``budget`` of all tokens, or to what the cells with a share
    have where that is less.
    """
    cells = raked(rows, targets, rounds)
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    scale = _scale(cells.where("w > 0"), budget * total)
    share = F.least(F.lit(1.0), F.lit(scale) * F.col("w") / F.col("tokens"))
    return cells.select(*DIMENSIONS, "tokens", share.alias("probability"))


def _same_cell(left: list[Column], cells: DataFrame) -> Column:
    return reduce(
        Column.__and__, (a.eqNullSafe(cells[d]) for a, d in zip(left, DIMENSIONS, strict=True))
    )


def mix(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    budget: float = BUDGET,
) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, kept) of every document.

    A document stays if its draw is below its cell's probability: the id decides, so rows that
    share an id and a cell stay or go together, as do rows without id. Null texts are empty
    and weigh one token. Columns besides id, text, source and lang are not read; an empty
    table gives an empty table.
    """
    rows = materialize(facts(docs), "facts")
    cells = probabilities(rows, targets, rounds, budget).drop("tokens")
    return rows.join(cells, _same_cell([rows[d] for d in DIMENSIONS], cells)).select(
        rows["doc_id"],
        *(rows[d] for d in DIMENSIONS),
        rows["tokens"],
        cells["probability"],
        (draw(rows["doc_id"]) < cells["probability"]).alias("kept"),
    )


def sampled(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    rounds: int = ROUNDS,
    budget: float = BUDGET,
) -> DataFrame:
    """The documents that ``mix`` keeps, with all their columns; no text is shuffled but where
    the table of cells is too large to be sent to every task.

    Null and empty texts weigh one token; rows that share an id and a cell, or have none, stay
    or go together; columns of any name are carried along; an empty table gives an empty table.
    """
    cells = probabilities(facts(docs), targets, rounds, budget)
    row = F.struct(*(docs[name] for name in docs.columns)).alias("_row")
    counted = docs.select(row, words(docs["text"]).alias("_words"))
    shaped = counted.select("_row", form(F.col("_row.text"), F.col("_words")).alias("_topic"))
    own = [shaped["_row.source"], shaped["_row.lang"], shaped["_topic"]]
    drawn = draw(shaped["_row.doc_id"]) < cells["probability"]
    return shaped.join(cells, _same_cell(own, cells) & drawn, "left_semi").select("_row.*")
