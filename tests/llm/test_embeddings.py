"""Embedding near-dedup against brute force in double precision."""

import random
from collections import Counter

import numpy as np
import pytest

from llm_tables import smallest_reachable
from strata.llm import embedding_dedup as e

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=9, dim=16):
    """Copies, near copies, chains and a hot group; and vectors that link with nothing."""
    rng, rows = np.random.default_rng(seed), []
    for group in range(120):
        base = rng.normal(size=dim)
        for _ in range(40 if group == 0 else rng.integers(1, 5)):
            noise = rng.choice([0.0, 0.05, 0.25])
            rows.append(
                ((base + noise * rng.normal(size=dim)) * rng.choice([1, 3]), int(group % 3))
            )
    rows = [
        (i, [float(x) for x in v.astype(np.float32)], label) for i, (v, label) in enumerate(rows)
    ]
    n, one = len(rows), rows[0][1]
    odd = [
        None,
        [],
        [0.0] * dim,
        [None, *one[1:]],
        [float("nan"), *one[1:]],
        [float("inf"), *one[1:]],
        one[:8],
        [x * 1e-30 for x in one],
    ]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 20, one, None), (n + 21, one, 7)]
    random.Random(seed).shuffle(rows)
    return rows


def plain(rows, cosine=0.93):
    units = [
        None if label is None else e.unit(
            v and np.array(v, np.float32).astype(float).tolist() if v and None not in v else v
        ) for _, v, label in rows
    ]
    links = [
        (rows[i][0], rows[j][0])
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
        and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine
    ]
    low = smallest_reachable([i for i, _, _ in rows], links)
    degree = Counter(x for link in links for x in link)
    return {i: (degree[i], low[i], low[i] == i) for i, _, _ in rows}


@pytest.mark.parametrize(
    ("cell_rows", "block_rows", "deviations"), [(1000, 1500, 4.0), (10, 7, 4.0), (10, 4, 1e9)]
)
def test_equals_brute_force(spark, cell_rows, block_rows, deviations):
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {
        r[0]: tuple(r)[1:] for r in e.embedding_dedup(
            frame, 0.93, cell_rows, block_rows, deviations
        ).collect()
    }
    wanted = plain(rows)
    found, there = (sum(x[0] for x in own.values()) for own in (got, wanted))
    assert found >= 0.99 * there and all(got[i][0] <= wanted[i][0] for i in wanted)
    if deviations > 100 or cell_rows == 1000:  # the whole radius is covered: nothing can be missed
        assert got == wanted


def test_awkward_rows(spark):
    one = [1.0, 2.0]
    rows = [
        (1, one, 1),
        (1, one, 1),
        (None, one, 1),
        (None, None, 1),
        (2, [2.0, 1.0], 1),
        (3, one, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS _key", "2 AS node", "3 AS n", "4 AS component", "5 AS cell"
    )
    got = Counter(map(tuple, e.embedding_dedup(frame).collect()))
    # In the order of (id, label, vector): the null ids first, then the two rows of id 1.
    assert got == Counter(
        [
            (None, 0, None, True),
            (None, 2, None, True),
            (1, 2, None, False),
            (1, 2, None, False),
            (2, 0, 2, True),
            (3, 0, 3, True),
        ]
    )
    assert e.embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_its_table(spark):
    from llm_tables import SF
    from strata.llm.queries import op9_embedding_dedup

    rows = [
        tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select(
            "vec_id", "embedding", "label"
        ).collect()
    ]
    assert {r[0]: tuple(r)[1:] for r in op9_embedding_dedup(spark, SF).collect()} == plain(rows)


def test_no_link_across_borders_is_lost(spark):
    """Vectors near three of 384 dimensions, which the centroids span too, in several cells."""
    rng = np.random.default_rng(12)
    few = rng.normal(size=(600, 3)) @ rng.normal(size=(3, 384))
    rows = [(i, [float(x) for x in v.astype(np.float32)], 0) for i, v in enumerate(few)]
    got = e.embedding_dedup(spark.createDataFrame(rows, SCHEMA), cell_rows=50).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == plain(rows)
