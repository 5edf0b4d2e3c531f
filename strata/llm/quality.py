"""Quality classifier by compression.

Two zstandard dictionaries are trained, on good and on bad labelled texts. A text compresses
better with the dictionary of its own kind, so the difference of the two compressed sizes,
normalised, tells the kind; a logistic curve fitted on other labelled texts turns it and the
sizes it comes from into a calibrated score. Whole texts are compressed, in blocks, so that a
long text's own repeats do not drown the dictionaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_package, whole
from strata.session import materialize

#: The model is fitted on a bounded sample: so many labelled texts of each class for its
#: dictionary and so many others for the curve, none longer than so many characters.
DICTIONARY_TEXTS = 600
CURVE_TEXTS = 2_000
SAMPLE_CHARS = 32_768
DICTIONARY_BYTES = 65_536
BLOCK_BYTES = 2_048
LEVEL = 3
ACCEPTED = 0.7
_PENALTY = 0.5
_ROUNDS = 60


class Model(NamedTuple):
    """Dictionaries and curve; without both classes only the share of good labels."""

    good: bytes
    bad: bytes
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    share: float


def _dictionary(texts: list[str]) -> bytes:
    blocks = [block for text in texts for block in _blocks(text.encode())]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few texts to train on: the texts themselves are the dictionary
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _blocks(data: bytes) -> Iterator[bytes]:
    for at in range(0, max(len(data), 1), BLOCK_BYTES):
        yield data[at : at + BLOCK_BYTES]


class Sizer:
    """Features of a text from its sizes under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = (
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=zstandard.ZstdCompressionDict(dictionary),
                write_content_size=False,
                write_dict_id=False,
            ).compress
            for dictionary in (good, bad)
        )

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        data = (text or "").encode()
        good = bad = 0
        for block in _blocks(data):
            good += len(self.good(block))
            bad += len(self.bad(block))
        size = len(data) + 16
        return (bad - good) / (bad + good), good / size, bad / size, float(np.log(size))


def _terms(features: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Constant, standardised features and their products."""
    z = np.clip((features - middle) / spread, -8, 8)
    n = z.shape[1]
    products = [z[:, i] * z[:, j] for i in range(n) for j in range(i, n)]
    return np.column_stack([np.ones(len(z)), z, *products])


def _loss(weights, terms, labels, counts) -> float:
    margin = np.where(labels == 1, 1, -1) * (terms @ weights)
    return float(
        (counts * np.logaddexp(0, -margin)).sum() + _PENALTY * (weights[1:] ** 2).sum() / 2
    )


def _curve(terms: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps, halved until they improve."""
    penalty = np.full(terms.shape[1], _PENALTY)
    penalty[0] = 1e-6
    weights = np.zeros(terms.shape[1])
    for _ in range(_ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(terms @ weights, -35, 35)))
        slope = terms.T @ (counts * (p - labels)) + penalty * weights
        bend = (terms * (counts * p * (1 - p))[:, None]).T @ terms + np.diag(penalty + 1e-9)
        step, before, size = np.linalg.solve(bend, slope), _loss(
            weights, terms, labels, counts
        ), 1.0
        while size > 1e-4 and _loss(weights - size * step, terms, labels, counts) > before:
            size /= 2
        weights = weights - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the texts of ``docs`` and the rows (doc_id, quality 0/1) of ``labels``.

    Labels that are null or contradict each other, and those of documents that are missing or
    have no text, are not used. The sample is the labelled rows of the smallest hashes in each
    class; its ids are chosen from ``labels`` alone, so no text moves but those chosen. The
    curve is weighted by how many labels each class has. With one class only, every score is
    the share of good labels (1 or 0; 0.5 without labels).
    """
    spark = docs.sparkSession
    ship_package(spark)
    agreed = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .where(F.col("quality") == F.col("most"))
        .select(
            F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("quality")
        )
    )
    totals = {
        row["quality"]: row["n"] for row in agreed.groupBy("quality").agg(
            F.count(F.lit(1)).alias("n")
        ).collect()
    }
    n_good, n_bad = totals.get(1, 0), totals.get(0, 0)
    none = Model(
        b"",
        b"",
        np.zeros(0),
        np.zeros(0),
        np.zeros(0),
        n_good / (n_good + n_bad) if totals else 0.5,
    )
    if not n_good or not n_bad:
        return none
    order = [F.xxhash64("_id"), F.col("_id")]
    wanted = DICTIONARY_TEXTS + CURVE_TEXTS
    chosen = [
        agreed.where(F.col("quality") == kind).orderBy(*order).limit(wanted) for kind in (0, 1)
    ]
    ids = materialize(chosen[0].union(chosen[1]), "sample-ids")
    # Bounded by the sample: a few thousand rows.
    texts = materialize(
        docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
        .where((F.char_length("text") > 0) & (F.char_length("text") <= SAMPLE_CHARS))
        .join(F.broadcast(ids), "_id"),
        "sample",
    )
    dictionaries, used = {}, []
    for kind in (0, 1):
        first = texts.where(F.col("quality") == kind).orderBy(*order, "text").limit(DICTIONARY_TEXTS)
        rows = first.collect()
        if len(rows) > 1:  # leave half of a small class for the curve
            rows = rows[
                : max(1, min(len(rows), texts.where(F.col("quality") == kind).count() // 2))
            ]
        if not rows:
            return none
        dictionaries[kind] = _dictionary([row["text"] for row in rows])
        used += [row["_id"] for row in rows]
    rest = texts.where(~F.col("_id").isin(used)) if len(used) < texts.count() else texts
    good, bad = dictionaries[1], dictionaries[0]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizer = Sizer(good, bad)
        for batch in batches:
            rows = [sizer.features(text) for text in batch["text"]]
            yield pd.DataFrame(rows, columns=list("abcd")).assign(
                quality=batch["quality"].to_numpy()
            )

    found = rest.select("text", "quality").mapInPandas(
        measure, "a double, b double, c double, d double, quality int"
    ).toPandas()
    found = found.sort_values(list("abcd")).reset_index(drop=True)
    labels_found = found["quality"].to_numpy()
    if len(set(labels_found.tolist())) < 2:
        return none
    features = found[list("abcd")].to_numpy(np.float64)
    middle, spread = features.mean(0), features.std(0) + 1e-9
    share = {0: n_bad / (labels_found == 0).sum(), 1: n_good / (labels_found == 1).sum()}
    counts = np.where(labels_found == 1, share[1], share[0]) * len(found) / (n_good + n_bad)
    weights = _curve(_terms(features, middle, spread), labels_found, counts)
    return Model(good, bad, middle, spread, weights, none.share)


def scored(model: Model, text: Column) -> Column:
    """The score of each text, 0 to 1: how likely it is good. Null is read as empty."""
    if not len(model.weights):
        return F.lit(float(model.share)) + F.octet_length(whole(text)) * 0.0

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sizer = Sizer(model.good, model.bad)
        for texts in batches:
            features = np.array([sizer.features(text) for text in texts], np.float64).reshape(-1, 4)
            margin = _terms(features, model.middle, model.spread) @ model.weights
            yield pd.Series(1 / (1 + np.exp(-np.clip(margin, -35, 35))))

    return score(text)


def accepted(docs: DataFrame, model: Model, least: float = ACCEPTED) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``least``; all columns as they are."""
    return docs.where(scored(model, docs["text"]) >= least)
