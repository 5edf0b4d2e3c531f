"""Mixing: raked marginals, calibrated probabilities, sampling."""

import random
from collections import Counter, defaultdict

import pytest

from llm_tables import SCHEMA, awkward, empty
from strata.llm import mixing


@pytest.fixture(scope="module")
def mixed(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        source = random.choice(["big"] * 6 + ["small", "tiny", None])
        text = "\n".join(
            " ".join(["w"] * random.randint(1, 60)) for _ in range(random.choice([1, 3, 25]))
        )
        rows.append((i, text, random.choice(["en", "en", "en", "de"]), source, None))
    return spark.createDataFrame(rows, SCHEMA)


def marginal(cells, dimension):
    total = defaultdict(float)
    for row in cells:
        total[row[dimension]] += row["tokens"] * row["probability"]
    everything = sum(total.values())
    return {value: x / everything for value, x in total.items()}


def kept_share(cells):
    return sum(r["tokens"] * r["probability"] for r in cells) / sum(r["tokens"] for r in cells)


@pytest.mark.parametrize("budget", [0.05, 0.5, 0.8, 0.97, 1.0])
def test_the_budget_is_met_with_cells_kept_whole_where_they_are_too_small(spark, mixed, budget):
    cells = mixing.raked(mixing.facts(mixed)).collect()
    got = {tuple(r[d] for d in mixing.DIMENSIONS): r for r in mixing.probabilities(mixing.facts(mixed), budget=budget).collect()}
    assert kept_share(got.values()) == pytest.approx(budget)
    # By bisection: the scale at which the cells' sums meet the budget.
    low, high, total = 0.0, 1e12, sum(r.tokens for r in cells)
    for _ in range(200):
        middle = (low + high) / 2
        enough = sum(min(r.tokens, middle * r.w) for r in cells) >= budget * total
        low, high = (low, middle) if enough else (middle, high)
    for r in cells:
        share = min(1, high * r.w / r.tokens)
        assert got[tuple(r[d] for d in mixing.DIMENSIONS)].probability == pytest.approx(share, abs=1e-6)


def test_one_odd_document_leaves_the_others_alone(spark, mixed):
    odd = spark.createDataFrame([(9999, "ten words " * 5, "xx", "a new source", None)], SCHEMA)
    before, after = (
        kept_share(mixing.probabilities(mixing.facts(docs)).collect()) for docs in (mixed, mixed.union(odd))
    )
    assert abs(before - after) < 0.001
    old = {r["doc_id"] for r in mixing.mix(mixed).collect() if r["kept"]}
    new = {r["doc_id"] for r in mixing.mix(mixed.union(odd)).collect() if r["kept"]}
    assert len(old ^ new) < 0.01 * len(old)


def test_convergence_is_measured(spark, mixed):
    few, many = (
        {r.dimension: r.error for r in mixing.convergence(mixing.raked(mixing.facts(mixed), rounds=n)).collect()}
        for n in (1, 8)
    )
    assert set(many) == set(mixing.DIMENSIONS)
    assert max(many.values()) < 1e-6 <= max(few.values()) and many["topic"] < 1e-9


def test_expected_tokens_have_the_target_shares(spark, mixed):
    targets = {"source": {"big": 0.3, "small": 0.5, "tiny": 0.2}, "lang": {"en": 0.5, "de": 0.5}}
    rows = mixing.facts(mixed.where("source IS NOT NULL"))
    # A budget that no cell is too small for.
    cells = mixing.probabilities(rows, targets, rounds=30, budget=0.05).collect()
    for dimension, shares in targets.items():
        assert marginal(cells, dimension) == pytest.approx(shares, abs=1e-6)
    assert max(row["probability"] for row in cells) < 1
    assert kept_share(cells) == pytest.approx(0.05)


def test_flattened_shares_by_default(spark, mixed):
    cells = mixing.probabilities(mixing.facts(mixed), rounds=30, budget=0.5).collect()
    for dimension, power in mixing.FLATTENING.items():
        own = Counter()
        for row in cells:
            own[row[dimension]] += row["tokens"]
        flat = {value: n**power for value, n in own.items()}
        assert marginal(cells, dimension) == pytest.approx(
            {v: x / sum(flat.values()) for v, x in flat.items()}, abs=1e-6
        )


def test_sample_follows_the_probabilities(spark, mixed):
    got = mixing.mix(mixed).collect()
    assert len(got) == 3000
    expected = sum(row["probability"] for row in got)
    assert abs(sum(row["kept"] for row in got) - expected) < 4 * 3000**0.5
    kept = mixing.sampled(mixed)
    assert kept.columns == mixed.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(
        r["doc_id"] for r in got if r["kept"]
    )


def test_values_without_share_get_none(spark, mixed):
    got = mixing.mix(mixed, {"source": {"big": 1.0}}).collect()
    assert {row["source"] for row in got if row["kept"]} == {"big"}


def test_awkward_rows(spark):
    frame = awkward(spark)
    got = mixing.mix(frame).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r["doc_id"] for r in frame.collect())
    kept = mixing.sampled(frame)
    assert kept.columns == frame.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        r["doc_id"] for r in got if r["kept"]
    )
    assert mixing.mix(empty(spark)).collect() == [] and mixing.sampled(empty(spark)).collect() == []
