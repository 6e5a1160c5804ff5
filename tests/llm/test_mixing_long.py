"""Budgets of sources whose documents are longer than the table of the knapsack."""

from __future__ import annotations

import random

import numpy as np

from commerce_marts.llm import mixing


def reached(lengths, counts, budget):
    sums = {0}
    for n, c in zip(lengths, counts):
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= budget}
    return max(sums)


def test_sums_of_documents_longer_than_the_table_are_found():
    assert mixing.fit([50_000, 60_000], [1, 1], 60_000).tolist() == [0, 1]
    rng = random.Random(4)
    for _ in range(60):
        lengths = sorted(rng.sample(range(30_000, 90_000), 4)) + [rng.randint(1, 9)]
        counts = [rng.randint(1, 3) for _ in lengths]
        budget = rng.randint(1, sum(n * c for n, c in zip(lengths, counts)))
        if rng.random() < 0.5:
            budget = sum(n * rng.randint(0, c) for n, c in zip(lengths, counts))
        got = mixing.fit(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts))
        total = int((got * np.array(lengths)).sum())
        whole = [min(c, int(c * max(0, budget - mixing.TABLE // 2) / sum(
            n * k for n, k in zip(lengths, counts)))) for c in counts]
        left = budget - sum(n * w for n, w in zip(lengths, whole))
        best = budget - left + reached(lengths, [c - w for c, w in zip(counts, whole)], left)
        assert total == best
