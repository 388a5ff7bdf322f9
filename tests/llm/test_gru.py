"""The recurrent network against plain loops: likelihood of whole texts, gradients of a window."""

import numpy as np
import pytest

from leadloom.llm import gru

LAYOUT = gru.Layout(np.array([0, 3, 5]), np.array([9.0, 4.0, 2.0, 7.0, 1.0]), np.array([3.0, 2.0]))
END = 0


@pytest.fixture
def weights():
    random = np.random.default_rng(7)
    found = gru.start(LAYOUT, hidden=4)
    return gru.Weights(*[(w + random.normal(0, 0.3, w.shape)).astype(np.float32) for w in found])


def plain(weights, table, state):
    """Negative log-likelihood of a window, word by word, and the states after it."""
    w = gru.Weights(*[x.astype(float) for x in weights])
    total, after = 0.0, []
    for row, h in zip(table, np.array(state, dtype=float), strict=True):
        for word, target in zip(row, row[1:], strict=False):
            h = h * (word != END)
            x, u = w.enter[word] + w.bias, h @ w.recur
            z, r = (1 / (1 + np.exp(-(x[a : a + 4] + u[a : a + 4]))) for a in (0, 4))
            h = z * h + (1 - z) * np.tanh(x[8:] + r * u[8:])
            kind = 0 if target < 3 else 1 if target < 5 else int(target) - 3
            logits = h @ w.to_class + w.class_bias
            total -= logits[kind] - np.log(np.exp(logits).sum())
            if target < 5:
                a, b = LAYOUT.begin[kind], LAYOUT.begin[kind + 1]
                inner = w.to_word[a:b] @ h + w.word_bias[a:b]
                total -= inner[target - a] - np.log(np.exp(inner).sum())
        after.append(h)
    return total, np.array(after)


def test_score_of_whole_texts(weights):
    random = np.random.default_rng(3)
    texts = [np.r_[random.integers(1, 7, n), END].astype(np.int32) for n in (40, 0, 3, 41)]
    found = gru.score(weights, LAYOUT, texts, END, rows=16)
    for text, value in zip(texts, found, strict=True):
        assert value == pytest.approx(-plain(weights, [np.r_[END, text]], np.zeros((1, 4)))[0], rel=1e-5)


@pytest.mark.parametrize("rows, exponent", [(256, 80.0), (2, 80.0), (2, 0.0)])
def test_gradients(weights, monkeypatch, rows, exponent):
    monkeypatch.setattr(gru, "_ROWS", rows)
    monkeypatch.setattr(gru, "_EXPONENT", exponent)
    random = np.random.default_rng(5)
    table = random.integers(0, 7, (3, 6)).astype(np.int32)
    state = random.normal(0, 0.4, (3, 4)).astype(np.float32)
    grads, after = gru.gradients(weights, LAYOUT, table, state, END)
    assert after == pytest.approx(plain(weights, table, state)[1], abs=1e-5)
    for k, w in enumerate(weights):
        wide = [x.astype(float) for x in weights]
        for at in np.ndindex(w.shape):
            sides = []
            for way in (1e-5, -1e-5):
                wide[k][at] = float(w[at]) + way
                sides.append(plain(gru.Weights(*wide), table, state)[0])
            wide[k][at] = float(w[at])
            assert grads[k][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=2e-4)


@pytest.mark.parametrize("steps, made", [(None, 16), (40, 40)])
def test_steps(weights, monkeypatch, steps, made):
    """Once through the stream, or a fixed number of steps; the order of words is learned."""
    seen = []
    real = gru.gradients
    monkeypatch.setattr(gru, "gradients", lambda *values: seen.append(values) or real(*values))
    stream = np.resize(np.array([1, 2, 3, 4, 5, 6, END], dtype=np.int32), 4 * 16 * 8)
    learned = gru.train(weights, LAYOUT, stream, END, streams=4, window=8, steps=steps)
    texts = [np.array([1, 2, 3, 4, 5, 6, END], dtype=np.int32)]
    assert gru.score(learned, LAYOUT, texts, END) > gru.score(weights, LAYOUT, texts, END)
    assert len(seen) == made
    # A new pass starts from empty states.
    assert all(not values[3].any() for values in seen[::16])
