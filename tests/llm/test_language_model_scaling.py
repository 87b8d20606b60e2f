"""Forward values scaled once in some steps give what scaling in every step gives."""

from __future__ import annotations

import numpy as np
import pytest

from rillflow.llm import hidden_markov


def _run(table, every, dtype=np.float32):
    rng = np.random.default_rng(1)
    lengths = np.array([30, 1, 8, 16, 17, 2])
    tokens = rng.integers(0, len(table), lengths.sum())
    layout = hidden_markov.Layout(lengths)
    layout.every = every
    start, move = np.array([0.4, 0.6]), np.array([[0.9, 0.1], [0.3, 0.7]])
    emit = np.empty((len(tokens), 2), dtype)
    emit[layout.place] = table[tokens]
    alpha, scale = hidden_markov.forward(layout, emit, start, move)
    log_p = np.add.reduceat(np.log(scale)[layout.place], layout.starts)
    return layout.every, log_p, *hidden_markov.backward(layout, emit, alpha, scale, move), alpha


@pytest.mark.parametrize("low, steps", [(0.1, hidden_markov.EVERY), (1e-9, 1)])
def test_scaling_may_wait_unless_values_get_too_small(low, steps):
    table = np.random.default_rng(0).uniform(low, 2 * low, (9, 2))
    every, *late = _run(table, hidden_markov.EVERY)
    _, *each = _run(table, 1, np.float64)
    assert every == steps
    for a, b in zip(late, each):
        assert a == pytest.approx(b, rel=1e-4)


def test_probabilities_over_the_largest_lose_nothing():
    table = np.random.default_rng(0).uniform(1e-9, 1e-3, (50, 4)).astype(np.float32)
    low, top = hidden_markov.leveled(table)
    assert (low.max(1) == 1).all() and np.allclose(low * np.exp(top)[:, None], table, rtol=1e-6)


def test_a_block_without_training_texts_gives_no_counts():
    none = np.zeros(0, np.int64)
    table = np.full((3, 4), 0.25, np.float32)
    share, starts, moves, own, log_p = hidden_markov.expected(none, none, 3, table, np.full(4, 0.25), np.full((4, 4), 0.25))
    assert not share.any() and not starts.any() and not moves.any() and not own.any() and log_p == 0
