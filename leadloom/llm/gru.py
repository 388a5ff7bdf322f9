"""A gated recurrent language model in numpy with a class-factored output softmax.

Words fall into classes. The model gives a distribution over classes from its state; inside a class
of *frequent* words a second softmax over the class's words; inside a class of *rare* words the
distribution is that of the corpus counts, and lies outside of this module. The input of a step is a
frequent word or the class of a rare one.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

HIDDEN = 24
STREAMS = 256
WINDOW = 32
_CLIP = 1.0
# Rows of a softmax worked on at a time (they stay in the cache), and the largest exponent that is safe in 32 bits.
_ROWS = 256
_EXPONENT = 80.0


class Layout(NamedTuple):
    """Where the words stand: frequent words are 0..n-1, sorted by class; rare classes follow.

    `begin[c]` is the first word of frequent class c (with one more at the end); `counts` are the
    corpus counts of the frequent words and `masses` those of the rare classes.
    """

    begin: np.ndarray
    counts: np.ndarray
    masses: np.ndarray

    @property
    def words(self) -> int:
        return len(self.counts)

    @property
    def frequent(self) -> int:
        return len(self.begin) - 1

    @property
    def inputs(self) -> int:
        return self.words + len(self.masses)

    def classes(self, tokens: np.ndarray) -> np.ndarray:
        """The class of each input number."""
        of_word = np.searchsorted(self.begin, np.arange(self.words), side="right") - 1
        table = np.r_[of_word, self.frequent + np.arange(len(self.masses))]
        return table[tokens]


class Weights(NamedTuple):
    enter: np.ndarray
    recur: np.ndarray
    bias: np.ndarray
    to_class: np.ndarray
    class_bias: np.ndarray
    to_word: np.ndarray
    word_bias: np.ndarray


def start(layout: Layout, hidden: int = HIDDEN, seed: int = 1) -> Weights:
    """Weights that give the corpus frequencies before any training."""
    random = np.random.default_rng(seed)
    mass = np.array([layout.counts[a:b].sum() for a, b in zip(layout.begin, layout.begin[1:], strict=False)])
    mass = np.r_[mass, layout.masses] + 0.1
    normal = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    return Weights(
        normal(layout.inputs, 3 * hidden),
        normal(hidden, 3 * hidden),
        np.zeros(3 * hidden, dtype=np.float32),
        normal(hidden, len(mass)),
        np.log(mass / mass.sum()).astype(np.float32),
        normal(layout.words, hidden),
        np.log(layout.counts + 0.1).astype(np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _order(values: np.ndarray) -> np.ndarray:
    """A stable order of small numbers, by their 16 bits where they have no more."""
    small = len(values) and values.max() < 1 << 16
    return np.argsort(values.astype(np.uint16) if small else values, kind="stable")


def step(weights: Weights, entered: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step for a batch of inputs (rows of `enter` with the bias): new state, gates, and parts of both."""
    n = state.shape[1]
    u = state @ weights.recur
    gates = _sigmoid(entered[:, : 2 * n] + u[:, : 2 * n])
    z, r = gates[:, :n], gates[:, n:]
    new = np.tanh(entered[:, 2 * n :] + r * u[:, 2 * n :])
    return new + z * (state - new), gates, new, u[:, 2 * n :]


def _bounded(matrix: np.ndarray, bias: np.ndarray) -> bool:
    """Whether exponentials of all logits fit: states lie within -1 and 1."""
    return bool((np.abs(matrix).sum(axis=0) + np.abs(bias)).max(initial=0) < _EXPONENT)


def _softmax(
    states: np.ndarray, matrix: np.ndarray, bias: np.ndarray, chosen: np.ndarray, bounded: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log of the chosen share of each row, the exponentials, and their sums."""
    logits = states @ matrix
    logits += bias
    if not bounded:
        logits -= logits.max(axis=1, keepdims=True)
    out = logits[np.arange(len(chosen)), chosen].astype(np.float64)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=logits.dtype)
    return out - np.log(total), logits, total


def _column_sums(x: np.ndarray) -> np.ndarray:
    return np.ones(len(x), dtype=x.dtype) @ x


def _slope(share: np.ndarray, total: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Gradient of the negative log of the chosen shares by the logits, in place."""
    share *= (1 / total)[:, None]
    share[np.arange(len(chosen)), chosen] -= 1
    return share


def log_likelihood(
    weights: Weights, layout: Layout, states: np.ndarray, targets: np.ndarray, backward: bool = False
) -> tuple[np.ndarray, list | None]:
    """Natural log of P(class) and, for frequent words, P(word | class), per row.

    With `backward`, also the gradients of the summed negative log-likelihood: those by the states
    and those by the output weights. Rows are sorted by class, so that all work is on stretches.
    """
    kind = layout.classes(targets)
    order = _order(kind)
    states, targets, kind = states[order], targets[order], kind[order]
    out = np.empty(len(order))
    grads = [np.zeros_like(w) for w in (states, *weights[3:])] if backward else None
    bounded = _bounded(weights.to_class, weights.class_bias)
    for a in range(0, len(order), _ROWS):
        rows = slice(a, a + _ROWS)
        value, share, total = _softmax(
            states[rows], weights.to_class, weights.class_bias, kind[rows], bounded
        )
        out[rows] = value
        if backward:
            slope = _slope(share, total, kind[rows])
            np.matmul(slope, weights.to_class.T, out=grads[0][rows])
            grads[1] += states[rows].T @ slope
            grads[2] += _column_sums(slope)
    bounded = _bounded(weights.to_word.T, weights.word_bias)
    edges = np.searchsorted(kind, np.arange(layout.frequent + 1))
    for c in np.flatnonzero(edges[1:] > edges[:-1]):
        a, b = layout.begin[c], layout.begin[c + 1]
        matrix, bias = weights.to_word[a:b], weights.word_bias[a:b]
        for first in range(edges[c], edges[c + 1], _ROWS):
            rows = slice(first, min(first + _ROWS, edges[c + 1]))
            chosen = targets[rows] - a
            value, share, total = _softmax(states[rows], matrix.T, bias, chosen, bounded)
            out[rows] += value
            if backward:
                slope = _slope(share, total, chosen)
                grads[0][rows] += slope @ matrix
                grads[3][a:b] += slope.T @ states[rows]
                grads[4][a:b] += _column_sums(slope)
    values = np.empty_like(out)
    values[order] = out
    if backward:
        by_state = np.empty_like(grads[0])
        by_state[order] = grads[0]
        grads[0] = by_state
    return values, grads


def gradients(
    weights: Weights, layout: Layout, table: np.ndarray, state: np.ndarray, end: int
) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradients of the summed negative log-likelihood of one window, and the state after it.

    A row of `table` is a stream's stretch of words: each is an input and the next one its target.
    The state before the window counts as given (truncated backpropagation).
    """
    inputs, targets = np.ascontiguousarray(table[:, :-1].T), table[:, 1:].T
    window, streams = inputs.shape
    n = state.shape[1]
    entered = weights.enter[inputs] + weights.bias
    # A document's end starts from an empty state.
    goes_on = (inputs != end).astype(np.float32)[:, :, None]
    old, states, kept = (np.empty((window, streams, n), dtype=np.float32) for _ in range(3))
    # What one unit of the state's gradient gives to both gates and the new value.
    by, by_u = (np.empty((window, streams, 3, n), dtype=np.float32) for _ in range(2))
    for k in range(window):
        np.multiply(state, goes_on[k], out=old[k])
        state, gates, new, u_new = step(weights, entered[k], old[k])
        states[k] = state
        z, r = gates[:, :n], gates[:, n:]
        one_less = 1 - z
        d_new = one_less * (1 - new * new)
        by[k, :, 0] = (old[k] - new) * z * one_less
        by[k, :, 1] = d_new * u_new * r * (1 - r)
        by[k, :, 2] = d_new
        by_u[k] = by[k]
        by_u[k, :, 2] *= r
        np.multiply(z, goes_on[k], out=kept[k])
    _, grads = log_likelihood(weights, layout, states.reshape(-1, n), targets.ravel(), backward=True)
    d_states = grads[0].reshape(window, streams, n)
    back = np.ascontiguousarray(weights.recur.T)
    d = np.zeros((streams, n), dtype=np.float32)
    for k in range(window - 1, -1, -1):
        d += d_states[k]
        by[k] *= d[:, None]
        by_u[k] *= d[:, None]
        d = d * kept[k] + (by_u[k].reshape(streams, 3 * n) @ back) * goes_on[k]
    d_x, d_u = by.reshape(-1, 3 * n), by_u.reshape(-1, 3 * n)
    # The same inputs side by side, summed by stretches.
    of = inputs.ravel()
    order = _order(of)
    of = of[order]
    at = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    g_enter = np.zeros_like(weights.enter)
    g_enter[of[at]] = np.add.reduceat(d_x[order], at, axis=0)
    return [g_enter, old.reshape(-1, n).T @ d_u, _column_sums(d_x), *grads[1:]], state


def train(
    weights: Weights,
    layout: Layout,
    stream: np.ndarray,
    end: int,
    streams: int = STREAMS,
    window: int = WINDOW,
    rate: float = 0.01,
    done: tuple[float, float] = (0.0, 1.0),
    steps: int | None = None,
) -> Weights:
    """Truncated backpropagation through time over one stream of documents, from given weights.

    The stream is cut into parallel parts of equal length, filled up from its beginning; the state
    is carried from window to window and set back after each document's end. All parts are gone
    through once, or, with `steps`, until so many windows are done. `done` is the share of the whole
    training before and after this stream; the rate falls with it.
    """
    if len(stream) < 2:
        return weights
    streams = max(1, min(streams, len(stream) // (4 * window)))
    length = -(-len(stream) // streams)
    round_about = np.resize(stream, streams * length + 1)
    table = np.c_[round_about[:-1].reshape(streams, length), round_about[length::length]]
    weights = Weights(*[w.copy() for w in weights])
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    each = -(-length // window)
    total = each if steps is None else steps
    for t in range(1, total + 1):
        at = (t - 1) % each
        if not at:
            state = np.zeros((streams, weights.recur.shape[0]), dtype=np.float32)
        part = table[:, at * window : (at + 1) * window + 1]
        found, state = gradients(weights, layout, part, state, end)
        words = part.shape[0] * (part.shape[1] - 1)
        share = done[0] + (done[1] - done[0]) * t / (total + 1)
        scale = rate * (1 - 0.9 * share) * np.sqrt(1 - 0.995**t) / (1 - 0.9**t)
        for w, g, m, v in zip(weights, found, first, second, strict=True):
            g *= np.float32(16 / words)
            np.clip(g, -_CLIP, _CLIP, out=g)
            m += np.float32(0.1) * (g - m)
            g *= g
            v += np.float32(0.005) * (g - v)
            np.sqrt(v, out=g)
            g += np.float32(1e-6)
            np.divide(m, g, out=g)
            g *= np.float32(scale)
            w -= g
    return weights


def score(
    weights: Weights, layout: Layout, texts: list[np.ndarray], end: int, rows: int = 32_768
) -> np.ndarray:
    """Log-likelihood of each whole text (input numbers), the state carried across windows.

    Texts run side by side, the longest first; a window holds about `rows` words, so the memory
    needed does not grow with the length of a text.
    """
    total = np.zeros(len(texts))
    order = sorted((k for k in range(len(texts)) if len(texts[k])), key=lambda k: -len(texts[k]))
    if not order:
        return total
    sizes = np.array([len(texts[k]) for k in order])
    starts = np.cumsum(sizes) - sizes
    flat = np.concatenate([texts[k] for k in order])
    found = np.zeros(len(order))
    state = np.zeros((len(order), weights.recur.shape[0]), dtype=np.float32)
    inputs = np.full(len(order), end, dtype=flat.dtype)
    at, active = 0, len(order)
    while active:
        window = max(1, rows // active)
        states, targets, owners = [], [], []
        for _ in range(window):
            active = int(np.searchsorted(-sizes, -at, side="left"))
            if not active:
                break
            state = step(weights, weights.enter[inputs[:active]] + weights.bias, state[:active])[0]
            inputs = flat[starts[:active] + at]
            states.append(state)
            targets.append(inputs)
            owners.append(np.arange(active))
            at += 1
        if states:
            values, _ = log_likelihood(
                weights, layout, np.concatenate(states), np.concatenate(targets)
            )
            found += np.bincount(np.concatenate(owners), weights=values, minlength=len(order))
    total[order] = found
    return total
