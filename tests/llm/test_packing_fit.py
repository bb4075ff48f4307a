"""The packing fit: every pattern is priced, none is thinned."""

import itertools

import numpy as np
import pytest

from tidewater.llm import packing


@pytest.mark.parametrize("size, seed", [(24, 0), (24, 1), (37, 2), (40, 3)])
def test_every_pattern_is_enumerated(size, seed):
    hist = np.random.default_rng(seed).integers(0, 3, size + 1)
    hist[0] = 0
    present = np.flatnonzero(hist).tolist()
    want = {tuple(sorted(p, reverse=True)) + (0,) * (3 - k) for k in (1, 2, 3)
            for p in itertools.combinations_with_replacement(present, k) if sum(p) == size}
    got = [tuple(p) for p in packing.enumerate_patterns(hist).tolist()]
    assert len(got) == len(set(got)) and set(got) == want


def test_no_pattern_could_lower_the_error_any_further():
    hist = np.random.default_rng(4).integers(0, 400, 65)
    hist[0] = 0
    patterns = packing.enumerate_patterns(hist)
    x = packing.fit_counts(hist, patterns, rounds=400, steps=300)
    left = (hist - np.bincount(patterns.ravel(), np.repeat(x, 3), len(hist))) * np.arange(65) / 64
    assert (x >= 0).all() and left[patterns].sum(axis=1).max() <= 0.01 * hist.max()


@pytest.mark.parametrize("hist", [np.zeros(2049, np.int64), np.eye(1, 2049, 1500, dtype=np.int64)[0] * 7])
def test_nothing_to_fit(hist):
    assert len(packing.enumerate_patterns(hist)) == 0
    assert sum(times for _, times in packing.plan_patterns(hist)) == hist.sum()


def histogram(lengths):
    return np.bincount(np.clip(lengths, 1, 2048).astype(int), minlength=2049)


@pytest.mark.parametrize("hist, over", [
    (histogram(np.exp(np.random.default_rng(5).normal(5.8, 0.9, 400_000))), 0.0005),
    (histogram(np.exp(np.random.default_rng(6).normal(6.6, 0.6, 400_000))), 0.0015),
    (histogram(np.random.default_rng(7).integers(1, 2049, 100_000)), 0.02)])
def test_plans_use_every_piece_and_stay_near_the_bound(hist, over):
    plan = packing.plan_patterns(hist)
    used = np.zeros(2049, np.int64)
    for lengths, times in plan:
        assert sum(lengths) <= 2048
        np.add.at(used, list(lengths), times)
    assert (used == hist).all()
    bound = max(-(-int((hist * np.arange(2049)).sum()) // 2048), int(hist[1025:].sum()))
    assert sum(times for _, times in plan) <= (1 + over) * bound
