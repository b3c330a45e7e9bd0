import numpy as np
import pytest

from caseloom.llm import gru_lm
from tests.llm.test_contracts import plain_log_likelihood, vocabulary


def weights(v, seed=0, spread=0.2):
    rng = np.random.default_rng(seed)
    return {k: x + rng.normal(0, spread, x.shape).astype(np.float32) for k, x in v.start().items()}


def test_outputs_wait_for_full_blocks(monkeypatch):
    """A long text alone gave a call for each window of 32 tokens."""
    v, rng, calls = vocabulary(), np.random.default_rng(1), []
    real = gru_lm._outputs
    monkeypatch.setattr(gru_lm, "_outputs", lambda p, v, h, ids, *more, **named: calls.append(len(ids)) or real(p, v, h, ids, *more, **named))
    sizes = np.array([1, 20_000, 3, 70])
    flat, ends = rng.integers(1, v.size + gru_lm.TAILS, sizes.sum()), np.cumsum(sizes)
    flat[ends - 1] = 0
    p = weights(v)
    got = gru_lm.log_likelihoods(p, v, flat, ends)
    assert sum(calls) == sizes.sum() and len(calls) <= 1 + sizes.sum() // (gru_lm.WINDOW * gru_lm.SLOTS)
    assert got == pytest.approx([plain_log_likelihood(p, v, x) for x in np.split(flat, ends[:-1])], rel=1e-4)


def test_large_logits_stay_finite():
    v = vocabulary()
    p = weights(v)
    p["bc"][3] += 500
    p["bw"][5] -= 500
    ids = np.arange(v.size + gru_lm.TAILS)
    h = np.random.default_rng(2).uniform(-1, 1, (len(ids), gru_lm.UNITS)).astype(np.float32)
    g = {}
    lp, dh = gru_lm._outputs(p, v, h, ids, g)
    assert np.isfinite(lp).all() and np.isfinite(dh).all() and all(np.isfinite(x).all() for x in g.values())


def test_shut_gates():
    v = vocabulary()
    p = weights(v)
    p["bu"][: 2 * gru_lm.UNITS : 2] = -200
    text = np.append(np.random.default_rng(3).integers(1, v.size + gru_lm.TAILS, 50), 0)
    assert gru_lm.log_likelihoods(p, v, text, np.array([51]))[0] == pytest.approx(plain_log_likelihood(p, v, text), rel=1e-4)


@pytest.mark.parametrize("words", [[0], [7] * 300, [3, 1, 3, 3, 2, 1, 0], list(range(50)) * 3])
def test_sums_by_word(words):
    x = np.array(words)
    rows, which, order, many = gru_lm._by_word(x)
    assert (rows[which] == x).all() and sorted(order) == list(range(len(x))) and sorted(rows) == sorted(set(words))
    at = 0
    for k, n in enumerate(many):  # the k-th of each word that has so many, in the order of rows
        assert (x[order[at : at + n]] == rows[:n]).all()
        at += n
    assert at == len(x)


def test_windows_learn_from_tokens_whatever_their_words():
    """Streams of one word only, and an odd last window."""
    v = vocabulary()
    p = v.start()
    texts = [np.append(np.full(700, 5), 0), np.append(np.arange(1, 41), 0)]
    new = gru_lm.train(p, v, texts)
    before, after = ([plain_log_likelihood(q, v, x) for x in texts[:1]] for q in (p, new))
    assert all(np.isfinite(x).all() for x in new.values()) and after[0] > before[0]
