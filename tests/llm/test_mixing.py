from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from tariffmart.llm.mixing import entropy, mix, mixture_draws, plan_mixture, repeats, tempered


def test_exponent_meets_the_entropy():
    plan = plan_mixture([("a", 9000), ("b", 900), ("c", 100)], 1.0, 0.9, 1e9)
    assert abs(entropy(plan.weights) - 0.9) < 1e-6 and 0 < plan.exponent < 1
    assert plan_mixture([("a", 50), ("b", 50)], 1.0, 0.9, 4.0).exponent == 1.0 or entropy(tempered([50, 50], 0.5)) == 1.0


def test_exponent_keeps_the_repetition_limit():
    tokens = [9000, 900, 100]
    plan = plan_mixture(list(zip("abc", tokens, strict=True)), 1.0, 1.0, 2.0)
    assert abs(repeats(tokens, plan.weights, 10_000) - 2.0) < 1e-4
    assert plan_mixture([("a", 10), ("b", 30)], 5.0, 1.0, 1.0).budgets == pytest.approx([10, 30])


def test_edges_of_the_plan():
    assert plan_mixture([], 1.0, 0.9, 2.0).weights == []
    assert plan_mixture([("a", 0)], 1.0, 0.9, 2.0).budgets == [0.0]
    assert plan_mixture([("a", 7), ("b", 0)], 1.0, 0.9, 2.0).weights == [1.0, 0.0]


def source_rows():
    rows = [(i, "w " * (1 + i % 9), None, "big") for i in range(600)]
    return rows + [(1000 + i, "w " * (1 + i % 5), None, "small") for i in range(40)] + [(2000 + i, "one two", None, None) for i in range(10)]


def test_draws_meet_budgets_and_passes_repeat_nothing(docs):
    rows = source_rows()
    settings = {"target_entropy": 0.8, "most_repeats": 3.0, "block_rows": 16}
    got = mixture_draws(docs(*rows), **settings).collect()
    tokens = Counter()
    for _, text, _, source in rows:
        tokens[source] += len(text.split())
    plan = plan_mixture(sorted(tokens.items(), key=lambda x: str(x[0])), 1.0, 0.8, 3.0)
    drawn, seen = Counter(), defaultdict(list)
    for r in got:
        drawn[r["source"]] += r["n_tokens"]
        seen[r["source"], r["pass"]].append(r["doc_id"])
    for source, budget in zip(plan.sources, plan.budgets, strict=True):
        assert budget - 9 <= drawn[source] <= budget + 1
    ids = {s: {i for i, *_, x in rows if x == s} for s in tokens}
    for (source, turn), found in seen.items():
        assert len(set(found)) == len(found)
        if (source, turn + 1) in seen:
            assert set(found) == ids[source]  # only the last pass is partial
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixture_draws(docs(*rows), **settings).collect()), key=repr)


def test_places_interleave_the_sources(docs):
    got = mixture_draws(docs(*source_rows()), target_entropy=0.8, block_rows=16).collect()
    for source in ("big", "small"):
        own = [r["place"] for r in got if r["source"] == source]
        assert 0 <= min(own) < 0.1 and 0.5 < max(own) < 1
    assert {r["weight"] for r in got if r["source"] == "big"} != {r["weight"] for r in got if r["source"] == "small"}


def test_without_repetition_rows_come_once_and_whole(docs):
    frame = docs(*source_rows())
    got = mix(frame, budget_share=0.5, target_entropy=1.0, most_repeats=1.0, block_rows=16).select("row.*")
    assert got.columns == frame.columns
    found = [r["doc_id"] for r in got.collect()]
    assert len(found) == len(set(found)) and {i for i in found if i >= 2000} == set(range(2000, 2010))


def test_edges(docs):
    assert mixture_draws(docs()).collect() == []
    got = mixture_draws(docs((1, None, None, "a"), (2, "", None, "a"), (3, "x", None, "b"), (3, "x", None, "b"), (None, "y z", None, None))).collect()
    assert {r["doc_id"] for r in got} <= {3, None} and all(r["n_tokens"] > 0 for r in got)
    assert mixture_draws(docs((1, "long " * 100_000, None, "a"))).first()["n_tokens"] == 100_000


def test_a_budget_from_the_weights_leaves_nothing_out():
    for tokens in ([9000, 900, 100], [5, 5, 5], [10**15, 3, 7, 10**12], [1], [0, 4]):
        plan = plan_mixture(list(zip("abcd", tokens, strict=False)), None, 0.98, 2.0)
        passes = [b / n for b, n in zip(plan.budgets, tokens, strict=True) if n]
        assert min(passes) == 1.0 and max(passes) <= 2.0001
    assert plan_mixture([("a", 9000), ("b", 900)], None, 0.5, 1.0).budgets == [9000.0, 900.0]


def test_equal_rows_spread_over_blocks(docs):
    rows = [(None, "same words again", None, "hot")] * 400 + [(i, "other words", None, "web") for i in range(200)]
    got = mixture_draws(docs(*rows), budget_share=None, block_rows=16, blocks_together=4).collect()
    sizes = Counter(r["block"] for r in got if r["source"] == "hot" and r["pass"] == 0)
    assert sum(sizes.values()) == 400 and max(sizes.values()) <= 3 * 16 and len(sizes) > 12
    assert Counter(r["doc_id"] for r in got if r["source"] == "web" and r["pass"] == 0) == Counter(range(200))
