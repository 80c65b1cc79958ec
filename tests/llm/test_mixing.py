import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm import mixing
from tallymark.llm.mixing import fit_budget, knapsack, mix
from tests.conftest import DATA

DOCS = "doc_id bigint, text string, source string, n_tokens int, copies string, budget int"
TARGETS = "source string, target_share double, max_repeats int, take int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 4)), min_size=1, max_size=4, unique_by=lambda x: x[0]), st.integers(0, 60))
def test_knapsack_against_brute_force(items, budget):
    lengths, counts = np.array([x for x, _ in items]), np.array([c for _, c in items])
    best = max(s for s in (sum(a * b for a, b in zip(lengths, c)) for c in itertools.product(*[range(c + 1) for c in counts])) if s <= budget)
    take = knapsack(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all() and int((take * lengths).sum()) == best


@pytest.mark.parametrize("seed", range(8))
def test_budgets_are_met_exactly(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(1, 4000, 600))
    counts = rng.integers(1, 2000 if seed % 2 else 4, len(lengths))
    whole = int((lengths * counts).sum())
    for budget in (0, 1, 17, whole // 3, whole // 2, whole - 1, whole, whole + 5):
        take = fit_budget(lengths, counts, budget, str(seed))
        got = int((take * lengths).sum())
        assert (take >= 0).all() and (take <= counts).all() and got <= budget
        if 4000 < budget < whole - 4000:
            assert got == budget
        if budget >= whole:
            assert got == whole


@pytest.mark.parametrize("seed", range(6))
def test_long_documents_against_brute_force(seed):
    """Lengths of 50,000 to 400,000 tokens: as near below the budget as any choice of documents."""
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(50_000, 400_000, 14))
    counts = rng.integers(1, 3, len(lengths))
    sums = {0}
    for w, c in zip(lengths.tolist(), counts.tolist()):
        sums = {s + w * k for s in sums for k in range(c + 1)}
    for budget in rng.integers(200_000, int((lengths * counts).sum()), 4).tolist():
        take = fit_budget(lengths, counts, budget, str(seed))
        assert (take >= 0).all() and (take <= counts).all()
        assert int((take * lengths).sum()) == max(s for s in sums if s <= budget)


def test_budgets_of_long_documents_that_can_be_met():
    lengths, counts = np.array([300_000, 310_000, 333_333, 400_001]), np.array([6, 6, 6, 6])
    assert int((fit_budget(lengths, counts, 1_333_332) * lengths).sum()) == 1_333_332
    rng = np.random.default_rng(3)
    lengths = np.unique(rng.integers(70_000, 200_000, 30))
    pick = rng.random(len(lengths)) < 0.5
    budget = int(lengths[pick].sum())
    assert int((fit_budget(lengths, np.ones(len(lengths), np.int64), budget) * lengths).sum()) == budget


def test_many_documents_of_one_divisor():
    lengths, counts = np.array([700, 1400, 2100]), np.array([10**7, 10**6, 10**5])
    assert int((fit_budget(lengths, counts, 3 * 10**9 + 123, "x") * lengths).sum()) == (3 * 10**9 + 123) // 700 * 700


def test_too_many_sources_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SOURCE_ROWS", 1)
    with pytest.raises(ValueError):
        mix(spark.createDataFrame([], DOCS), spark.createDataFrame([("a", 0.5, 1, 7), ("b", 0.5, 1, 7)], TARGETS))


def test_a_giant_document_does_not_break_the_fit():
    lengths, counts = np.array([1, 2, 10_000_000]), np.array([50, 50, 1])
    assert int((fit_budget(lengths, counts, 100) * lengths).sum()) == 100
    assert int((fit_budget(lengths, counts, 10_000_020) * lengths).sum()) == 10_000_020
    assert fit_budget(np.array([]), np.array([]), 5).tolist() == []


def test_shares_and_repeats(spark):
    docs, targets = (spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "source_targets"))
    used, shares = mix(docs, targets)
    rows, s = used.collect(), {r.source: r for r in shares.collect()}
    limit = {r.source: r.max_repeats for r in targets.collect()}
    assert all(1 <= r.copies <= limit[r.source] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    have = sum(r.target_share for r in s.values() if r.tokens_available)
    for source, r in s.items():
        assert r.tokens_used == sum(x.n_tokens * x.copies for x in rows if x.source == source)
        assert r.records_used == sum(x.copies for x in rows if x.source == source)
        if r.tokens_available:
            assert r.actual_share == pytest.approx(r.target_share / have, abs=0.01)
    assert any(r.tokens_used == r.tokens_available * r.max_repeats for r in s.values())


def test_the_seed_decides(spark):
    docs, targets = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "source_targets"))
    pick = lambda d, n: sorted((r.doc_id, r.copies) for r in mix(d, targets, seed=n)[0].collect())
    assert pick(docs, 1) == pick(docs.repartition(3), 1)


def test_hot_length_is_split_and_exact(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANKED", 20)
    docs = spark.createDataFrame([(i, "same text here", "a", 1, "x", 2) for i in range(300)] + [(1000 + i, f"other {i}", "b", 1, "x", 2) for i in range(50)], DOCS)
    targets = spark.createDataFrame([("a", 0.5, 1, 7), ("b", 0.5, 1, 7)], TARGETS)
    used, shares = mix(docs, targets)
    s = {r.source: r for r in shares.collect()}
    assert abs(s["a"].tokens_used - s["b"].tokens_used) <= 3
    assert sum(r.n_tokens for r in used.filter("source = 'a'").collect()) == s["a"].tokens_used


def test_cases(spark):
    rows = [(1, None, "a", 1, "x", 2), (2, "", "a", 1, "x", 2), (3, "some text", "a", 1, "x", 2), (3, "some text", "a", 1, "x", 2), (4, "left out", None, 1, "x", 2), (5, "left out", "z", 1, "x", 2), (6, "text", "c", 1, "x", 2)]
    targets = spark.createDataFrame([("a", 0.5, 2, 7), ("b", 0.3, 2, 7), ("c", 0.2, None, 7), (None, 0.1, 1, 1), ("d", None, 1, 1)], TARGETS)
    used, shares = mix(spark.createDataFrame(rows, DOCS), targets)
    assert sorted((r.doc_id, r.copies) for r in used.collect()) == [(3, 2), (3, 2)]
    s = {r.source: (r.tokens_used, r.actual_share) for r in shares.collect()}
    assert set(s) == {"a", "b", "c", "d"} and s["a"][1] == 1.0 and s["b"] == s["c"] == s["d"] == (0, 0.0)
    empty = spark.createDataFrame([], DOCS)
    assert mix(empty, targets)[0].count() == 0 and {r.actual_share for r in mix(empty, targets)[1].collect()} == {0.0}
    assert mix(spark.createDataFrame(rows, DOCS), targets.limit(0))[0].count() == 0
