"""Quality classifier: held-out accuracy, and what it does without enough labels."""

import random

import pytest
from pyspark.sql import functions as F

from llm_tables import SCHEMA, awkward, empty
from strata.llm import quality
from strata.llm.queries import held_out


@pytest.fixture(scope="module")
def labelled(spark):
    """Prose of invented words against shouting, symbols, lists and repeats."""
    random.seed(8)
    syllables = "ka to mi re su lo ne va di po ri se".split()

    def prose(n):
        return " ".join(
            "".join(random.choices(syllables, k=random.randint(1, 4))) for _ in range(n)
        ).capitalize() + "."

    def junk(n):
        kind = random.randrange(4)
        if kind == 0:
            return prose(n).upper().replace(" ", "!! ")
        if kind == 1:
            return prose(n).replace(" ", random.choice(["### ", "$$$ ", "%%% "]))
        if kind == 2:
            return prose(n).replace(" ", " | ")
        return " ".join([prose(1)] * n)

    rows, labels = [], []
    for i in range(1200):
        good = int(random.random() < 0.7)
        n = random.randint(20, 300)
        rows.append((i, prose(n) if good else junk(n), "en", "a", None))
        if i % 5:
            labels.append((i, good, 0))
    labels += [(2000, 1, 0), (None, 0, 0), (7, None, 0), (0, 1, 0), (0, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(
        labels, "doc_id long, quality int, toxic int"
    )


def test_held_out_accuracy(labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels.where(~held_out()))
    scored = docs.withColumn("score", quality.scored(model, docs["text"]))
    judged = scored.join(
        labels.where(held_out() & F.col("quality").isNotNull()), "doc_id"
    ).collect()
    right = [
        (row["score"] >= quality.ACCEPTED) == bool(row["quality"]) for row in judged if row["doc_id"]
    ]
    assert len(right) > 150 and sum(right) / len(right) > 0.97
    assert all(0 <= row["score"] <= 1 for row in judged)
    again = quality.fit(docs, labels.where(~held_out()))
    assert (again.weights == model.weights).all() and again.good == model.good


def test_awkward_rows_get_a_score(spark, labelled):
    model = quality.fit(*labelled)
    frame = awkward(spark)
    scores = frame.select(quality.scored(model, frame["text"]).alias("s")).collect()
    assert len(scores) == frame.count() and all(0 <= row["s"] <= 1 for row in scores)
    kept = quality.accepted(frame, model)
    assert kept.columns == frame.columns and kept.count() == sum(
        row["s"] >= quality.ACCEPTED for row in scores
    )
    assert quality.accepted(empty(spark), model).collect() == []
    quality.fit(frame, labelled[1].withColumn("text", F.lit("clash")))


@pytest.mark.parametrize(("kinds", "share"), [((), 0.5), ((1,), 1.0), ((0,), 0.0)])
def test_without_both_classes_the_score_is_the_share(spark, labelled, kinds, share):
    docs, labels = labelled
    model = quality.fit(
        docs, labels.where(F.col("quality").isin(*kinds) if kinds else F.lit(False))
    )
    rows = docs.limit(3).select(quality.scored(model, docs["text"]).alias("s")).collect()
    assert [row["s"] for row in rows] == [share] * 3


def test_few_labels_give_a_model(spark, labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels.where(F.col("doc_id").between(1, 30)))
    assert len(model.weights) and all(
        0 <= r[0] <= 1 for r in docs.limit(20).select(quality.scored(model, docs["text"])).collect()
    )
