"""Long texts are cut into pieces that share numpy steps, with the results of the whole text."""

from __future__ import annotations

import numpy as np
import pytest

from rillflow.llm import hidden_markov

LENGTHS = np.array([3, 7000, 1, hidden_markov.CUT, 2 * hidden_markov.CUT, 2500, hidden_markov.CUT + 1])


def _model(low):
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 40, LENGTHS.sum())
    table = rng.uniform(low, 2 * low, (40, 4)).astype(np.float32) ** 2
    return tokens, table, np.array([0.1, 0.2, 0.3, 0.4]), hidden_markov.normal(rng.uniform(0, 1, (4, 4)) + 5 * np.eye(4))


def test_a_long_text_takes_no_more_steps_than_a_piece_has_tokens():
    pieces = hidden_markov.Pieces(LENGTHS)
    assert max(len(pieces.heads.active), len(pieces.tails.active)) <= hidden_markov.CUT
    assert pieces.heads.active.sum() + pieces.tails.active.sum() == LENGTHS.sum()
    tokens = np.arange(LENGTHS.sum())
    assert np.array_equal(pieces.by_text(pieces.laid(tokens)), tokens)


@pytest.mark.parametrize("low, every", [(0.1, hidden_markov.EVERY), (1e-9, hidden_markov.EVERY), (0.1, 1)])
def test_pieces_give_what_whole_texts_give(low, every, monkeypatch):
    monkeypatch.setattr(hidden_markov, "EVERY", every)
    tokens, table, start, move = _model(low)
    share, starts, moves, own, log_p = hidden_markov.expected(tokens, LENGTHS, 40, table, start, move)

    layout = hidden_markov.Layout(LENGTHS)
    layout.every = 1
    emit = np.empty((len(tokens), 4))
    emit[layout.place] = table[tokens]
    alpha, scale = hidden_markov.forward(layout, emit, start, move)
    assert log_p == pytest.approx(np.log(scale).sum(), rel=1e-6)
    whole_starts, whole_moves = hidden_markov.backward(layout, emit, alpha, scale, move)
    assert starts == pytest.approx(whole_starts, rel=1e-4)
    assert moves == pytest.approx(whole_moves, rel=1e-4)
    gamma = alpha[layout.place]
    for k in range(4):
        assert share[:, k] == pytest.approx(np.bincount(tokens, gamma[:, k], 40), rel=1e-4)
    assert np.array_equal(own, np.bincount(tokens, minlength=40))


def test_all_texts_are_scored_over_several_small_and_long_ones(spark):
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, n) % 50)) for i, n in enumerate([2600, 0, 30, 1500, 1024] * 4)]
    df = spark.createDataFrame([*texts, (None, None), (0, "w1")], "doc_id long, text string").coalesce(1)
    got = hidden_markov.fit_and_score(df, rise=0.5).collect()
    assert sorted(r.n_tokens for r in got) == sorted([2601, 1, 31, 1501, 1025] * 4 + [1, 2])
    assert all(r.n_known <= r.n_tokens and np.isfinite(r.score) and r.score < 0 for r in got)
    assert sum(r.n_tokens for r in got if not r.held_out) == got[0].train_tokens
